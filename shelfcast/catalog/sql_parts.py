"""DuckDB statements of the pipeline stages, the expected side of the comparisons."""

from pyspark.sql.types import IntegerType

from shelfcast.schemas import FEATURES, REQUEST_SCHEMA

_HISTORY = """lag(unidades_vendidas, 1) OVER g AS lag_1,
         lag(unidades_vendidas, 7) OVER g AS lag_7,
         avg(unidades_vendidas) OVER (PARTITION BY id_tienda, id_producto ORDER BY fecha
           ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS media_movil_7"""
_GROUPS = "WINDOW g AS (PARTITION BY id_tienda, id_producto ORDER BY fecha)"
_CALENDAR = """CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         CAST(day(fecha) AS INTEGER) AS dia, CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana,
         CASE WHEN dayofweek(fecha) IN (0, 6) THEN 1 ELSE 0 END AS es_fin_de_semana"""
_DAY_HISTORY = """max(unidades_vendidas) OVER (PARTITION BY id_tienda, id_producto
           ORDER BY datediff('day', DATE '1970-01-01', fecha)
           RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS lag_1,
         max(unidades_vendidas) OVER (PARTITION BY id_tienda, id_producto
           ORDER BY datediff('day', DATE '1970-01-01', fecha)
           RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING) AS lag_7,
         avg(unidades_vendidas) OVER (PARTITION BY id_tienda, id_producto
           ORDER BY datediff('day', DATE '1970-01-01', fecha)
           RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS media_movil_7"""


def clean_sales(source: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT DISTINCT TRY_CAST(fecha AS DATE) AS fecha, id_tienda, id_producto,
           unidades_vendidas, precio_unitario FROM {source})
  WHERE fecha IS NOT NULL AND id_tienda IS NOT NULL AND id_producto IS NOT NULL
    AND unidades_vendidas >= 0 AND precio_unitario >= 0"""


def clean_promotions(source: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT fecha, id_tienda, id_producto, promocion_activa,
           coalesce(descuento_pct, 0) AS descuento_pct
    FROM (SELECT DISTINCT TRY_CAST(fecha AS DATE) AS fecha, id_tienda, id_producto,
                 promocion_activa, descuento_pct FROM {source}))
  WHERE fecha IS NOT NULL AND id_tienda IS NOT NULL AND id_producto IS NOT NULL
    AND promocion_activa IS NOT NULL AND descuento_pct BETWEEN 0 AND 100"""


def clean_weather(source: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT fecha, temperatura_media, coalesce(lluvia_mm, 0) AS lluvia_mm
    FROM (SELECT DISTINCT TRY_CAST(fecha AS DATE) AS fecha, temperatura_media, lluvia_mm
          FROM {source}))
  WHERE fecha IS NOT NULL AND lluvia_mm >= 0"""


def clean_products(source: str) -> str:
    return f"""
  SELECT id_producto, coalesce(nombre_producto, 'Desconocido') AS nombre_producto,
         coalesce(categoria, 'Sin categoria') AS categoria
  FROM (SELECT DISTINCT id_producto, nombre_producto, categoria FROM {source})
  WHERE id_producto IS NOT NULL"""


def row_history(source: str) -> str:
    return f"SELECT *, {_HISTORY} FROM {source} {_GROUPS}"


def day_history(source: str) -> str:
    return f"SELECT *, {_DAY_HISTORY} FROM {source}"


def calendar(source: str) -> str:
    return f"SELECT *, {_CALENDAR} FROM {source}"


def with_history_only(source: str) -> str:
    return f"""SELECT * FROM {source}
  WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL AND media_movil_7 IS NOT NULL
    AND NOT isnan(lag_1) AND NOT isnan(lag_7) AND NOT isnan(media_movil_7)"""


PARTS = {
    "ventas_limpias": clean_sales("{ventas}"),
    "promociones_limpias": clean_promotions("{promociones}"),
    "clima_limpio": clean_weather("{clima}"),
    "productos_limpios": clean_products("{productos}"),
    "ventas_de_crudas": clean_sales("{ventas_crudas}"),
    "promociones_de_crudas": clean_promotions("{promociones_crudas}"),
    "clima_de_crudas": clean_weather("{clima}"),
    "productos_de_crudas": clean_products("{productos}"),
    "unidas": """
  SELECT * FROM {ventas_limpias} LEFT JOIN {promociones_limpias}
      USING (fecha, id_tienda, id_producto)
    LEFT JOIN {clima_limpio} USING (fecha)
    LEFT JOIN {productos_limpios} USING (id_producto)""",
    "unidas_repetidas": """
  SELECT v.* FROM {ventas_limpias} v LEFT JOIN (
      SELECT fecha, id_tienda, id_producto FROM {promociones_limpias}
      UNION ALL SELECT fecha, id_tienda, id_producto FROM {promociones_limpias})
    USING (fecha, id_tienda, id_producto)""",
    "mediana": """
  SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY temperatura_media) AS m FROM {unidas}""",
    "rellenas": """
  SELECT id_producto, fecha, id_tienda, unidades_vendidas, precio_unitario,
         coalesce(promocion_activa, 0) AS promocion_activa,
         coalesce(descuento_pct, 0) AS descuento_pct,
         coalesce(temperatura_media, (SELECT m FROM {mediana})) AS temperatura_media,
         coalesce(lluvia_mm, 0) AS lluvia_mm, nombre_producto, categoria
  FROM {unidas}""",
    "con_calendario": calendar("{rellenas}"),
    "con_historia": row_history("{con_calendario}"),
    "dataset": with_history_only("{con_historia}"),
    "dataset_por_dia": with_history_only("(" + day_history("{con_calendario}") + ")"),
}

METRICS = """round(avg(abs(unidades_vendidas - lag_7)), 4) AS mae,
       round(sqrt(avg((unidades_vendidas - lag_7) ** 2)), 4) AS rmse,
       round(1 - avg((unidades_vendidas - lag_7) ** 2) / var_pop(unidades_vendidas), 4) AS r2"""

_FIELDS = FEATURES
_INTEGER_FIELDS = tuple(f.name for f in REQUEST_SCHEMA.fields if isinstance(f.dataType, IntegerType))


def _number(name: str) -> str:
    """Value of a plain decimal number; other spellings of numbers are none."""
    plain = f"regexp_full_match(trim({name}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
    value = f"TRY_CAST({name} AS DOUBLE)"
    return f"(CASE WHEN {plain} AND isfinite({value}) THEN {value} END)"


def _checked(name: str) -> str:
    if name in _INTEGER_FIELDS:
        value = f"TRY_CAST({_number(name)} AS INTEGER)"
        return f"CASE WHEN {_fault(name)} IS NULL THEN {value} END AS {name}"
    return f"{_number(name)} AS {name}"


def _fault(name: str) -> str:
    number = _number(name)
    valid = f"{number} IS NOT NULL"
    if name in _INTEGER_FIELDS:
        valid += f" AND {number} = floor({number}) AND abs({number}) < 2147483648"
    return f"CASE WHEN {valid} THEN NULL ELSE '{name}' END"


PARTS["historia_densa"] = row_history("{ventas_densas}")
PARTS["rellenas_promocion"] = """
  SELECT v.*, coalesce(p.promocion_activa, 0) AS promocion_activa
  FROM {ventas} v LEFT JOIN {promociones} p USING (fecha, id_tienda, id_producto)"""
PARTS["peticiones_revisadas"] = (
    "SELECT "
    + ", ".join(_checked(name) for name in _FIELDS)
    + ", concat_ws(',', "
    + ", ".join(_fault(name) for name in _FIELDS)
    + ") AS motivos FROM {peticiones}"
)
