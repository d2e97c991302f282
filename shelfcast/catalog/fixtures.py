"""Retail tables derived from the given TPC-H-like tables, and soiled variants of them.

The statements run in Spark and in DuckDB. ``{name}`` stands for a given table or for
another statement of this module.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfcast.sources.tables import RetailTables

_SALE_KEY = """CAST(l_shipdate AS DATE) AS fecha, s_nationkey AS id_tienda,
         CAST(substr(p_brand, 7) AS INT) AS id_producto"""
_SALE_LINES = """{lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
    JOIN {part} ON l_partkey = p_partkey"""

STATEMENTS = {
    # store = nation of the supplier, product = brand number
    "ventas": f"""
  SELECT {_SALE_KEY},
         sum(l_quantity) AS unidades_vendidas,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
           / (100 * sum(l_quantity)) AS precio_unitario
  FROM {_SALE_LINES} GROUP BY 1, 2, 3""",
    "promociones": f"""
  SELECT {_SALE_KEY},
         1 AS promocion_activa,
         max(CAST(round(l_discount * 100) AS INT)) AS descuento_pct
  FROM {_SALE_LINES} WHERE l_discount >= 0.05 GROUP BY 1, 2, 3""",
    "clima": """
  SELECT CAST(o_orderdate AS DATE) AS fecha,
         round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE)
           / count(*) / 1000000, 1) AS temperatura_media,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS DOUBLE)
           AS lluvia_mm
  FROM {orders} GROUP BY 1""",
    "productos": """
  SELECT CAST(substr(p_brand, 7) AS INT) AS id_producto, p_brand AS nombre_producto,
         min(p_type) AS categoria
  FROM {part} GROUP BY 1, 2""",
    # dense: three stores, five products, one row per day
    "ventas_densas": """
  SELECT CAST(ts AS DATE) AS fecha, CAST(user_id % 3 AS INT) AS id_tienda,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 ELSE 5 END AS id_producto,
         CAST(count(*) AS DOUBLE) AS unidades_vendidas
  FROM {events} GROUP BY 1, 2, 3""",
    # text dates, missing keys and values, signs, and whole rows twice
    "ventas_sucias": """
  SELECT CASE WHEN id_producto = 1 THEN 'bad' WHEN id_producto = 2 THEN '2025-13-01'
              WHEN id_producto = 3 THEN '2025-1-3' WHEN id_producto = 4 THEN NULL
              ELSE CAST(fecha AS STRING) END AS fecha,
         CASE WHEN id_producto % 7 = 0 THEN NULL ELSE id_tienda END AS id_tienda,
         CASE WHEN id_tienda % 7 = 0 THEN NULL ELSE id_producto END AS id_producto,
         CASE WHEN (id_tienda + id_producto) % 9 = 0 THEN NULL
              WHEN id_tienda % 5 = 0 THEN -unidades_vendidas
              ELSE unidades_vendidas END AS unidades_vendidas,
         CASE WHEN id_tienda % 11 = 0 THEN NULL
              WHEN id_producto % 6 = 0 THEN -precio_unitario
              ELSE precio_unitario END AS precio_unitario
  FROM {ventas_y_copias}""",
    "ventas_y_copias": """
  SELECT fecha, id_tienda, id_producto, unidades_vendidas, precio_unitario FROM {ventas}
  UNION ALL
  SELECT fecha, id_tienda, id_producto, unidades_vendidas, precio_unitario
  FROM {ventas} WHERE id_producto % 2 = 0""",
    "promociones_sucias": """
  SELECT CASE WHEN id_tienda = 1 THEN 'bad' ELSE CAST(fecha AS STRING) END AS fecha,
         id_tienda, id_producto,
         CASE WHEN id_tienda % 8 = 0 THEN NULL ELSE promocion_activa END AS promocion_activa,
         CASE id_producto % 6 WHEN 0 THEN NULL WHEN 1 THEN -5 WHEN 2 THEN 0 WHEN 3 THEN 100
              WHEN 4 THEN 101 ELSE descuento_pct END AS descuento_pct
  FROM {promociones}""",
    "clima_sucio": """
  SELECT CASE WHEN extract(day FROM fecha) = 1 THEN 'bad' ELSE CAST(fecha AS STRING) END AS fecha,
         CASE WHEN extract(day FROM fecha) % 5 = 0 THEN NULL
              ELSE temperatura_media END AS temperatura_media,
         CASE WHEN extract(day FROM fecha) % 3 = 0 THEN NULL
              WHEN extract(day FROM fecha) % 7 = 0 THEN -1.0 - lluvia_mm
              ELSE lluvia_mm END AS lluvia_mm
  FROM {clima}
  UNION ALL
  SELECT CAST(fecha AS STRING) AS fecha, temperatura_media, lluvia_mm
  FROM {clima} WHERE extract(day FROM fecha) = 2""",
    "productos_sucios": """
  SELECT CASE WHEN id_producto % 10 = 0 THEN NULL ELSE id_producto END AS id_producto,
         CASE WHEN id_producto % 3 = 0 THEN NULL ELSE nombre_producto END AS nombre_producto,
         CASE WHEN id_producto % 4 = 0 THEN NULL ELSE categoria END AS categoria
  FROM {productos}
  UNION ALL
  SELECT id_producto, nombre_producto, categoria FROM {productos} WHERE id_producto = 5""",
    # requests as text, some with missing or malformed fields
    "peticiones": """
  SELECT CASE WHEN id_tienda = 3 THEN 'abc' WHEN id_tienda = 4 THEN '4.5'
              ELSE CAST(id_tienda AS STRING) END AS id_tienda,
         CAST(id_producto AS STRING) AS id_producto,
         CASE WHEN id_producto = 5 THEN 'caro' ELSE CAST(precio_unitario AS STRING) END
           AS precio_unitario,
         CASE WHEN id_producto = 6 THEN NULL ELSE '1' END AS promocion_activa,
         CAST(CAST(id_producto % 4 AS INT) * 5 AS STRING) AS descuento_pct,
         CASE WHEN id_producto = 9 THEN 'NaN' WHEN id_producto = 10 THEN 'Infinity'
              WHEN id_producto = 12 THEN '10f' WHEN id_producto = 13 THEN '1e1'
              ELSE CAST(CAST(id_tienda + id_producto AS INT) AS STRING) END AS temperatura_media,
         CAST(CAST(id_tienda % 3 AS INT) AS STRING) AS lluvia_mm,
         CAST(CAST(extract(year FROM fecha) AS INT) AS STRING) AS anio,
         CASE WHEN id_tienda = 7 THEN '99999999999'
              ELSE CAST(CAST(extract(month FROM fecha) AS INT) AS STRING) END AS mes,
         CAST(CAST(extract(day FROM fecha) AS INT) AS STRING) AS dia,
         '1' AS dia_semana, '1' AS es_fin_de_semana,
         CAST(unidades_vendidas AS STRING) AS lag_1,
         CAST(unidades_vendidas AS STRING) AS lag_7,
         CASE WHEN id_producto = 8 THEN '' ELSE CAST(unidades_vendidas AS STRING) END
           AS media_movil_7
  FROM {ventas}""",
    # as raw files have them: some units and discounts with decimals, some fields empty
    "ventas_crudas": """
  SELECT fecha, id_tienda, id_producto,
         CASE WHEN id_producto % 9 = 0 THEN NULL WHEN id_producto % 2 = 0
              THEN unidades_vendidas + 0.5 ELSE unidades_vendidas END AS unidades_vendidas,
         precio_unitario FROM {ventas}""",
    "promociones_crudas": """
  SELECT fecha, id_tienda, id_producto, promocion_activa,
         CASE WHEN id_producto % 9 = 0 THEN NULL
              ELSE descuento_pct + CAST(id_producto % 4 AS DOUBLE) / 4 END AS descuento_pct
  FROM {promociones}""",
    # two prices per product, the second only for some; product 9 has none
    "precios": """
  SELECT CAST(substr(p_brand, 7) AS INT) AS id_producto,
         CAST(min(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS precio_base
  FROM {part} WHERE p_brand <> 'Brand#9' GROUP BY 1""",
    # two sales per key, so that history is a matter of ties
    "ventas_doble": """
  SELECT fecha, id_tienda, id_producto, unidades_vendidas, precio_unitario FROM {ventas}
  UNION ALL
  SELECT fecha, id_tienda, id_producto, unidades_vendidas + 1.25 AS unidades_vendidas,
         precio_unitario FROM {ventas}""",
    # same key, several values
    "promociones_repetidas": """
  SELECT fecha, id_tienda, id_producto, promocion_activa, descuento_pct FROM {promociones}
  UNION ALL
  SELECT fecha, id_tienda, id_producto, promocion_activa,
         CASE WHEN id_producto % 2 = 0 THEN NULL ELSE descuento_pct + 7 END AS descuento_pct
  FROM {promociones} WHERE id_producto % 3 = 0""",
    "productos_nuevos": """
  SELECT id_producto + 20 AS id_producto, 'nuevo' AS nombre_producto, categoria
  FROM {productos}""",
}
GIVEN_TABLES = ("lineitem", "orders", "supplier", "part", "events")
# Types of the given tables by path: footers are read once per application, not per query.
_SCHEMAS: dict[tuple[str, str], StructType] = {}
_NAME = re.compile(r"{(\w+)}")


class Fixtures:
    """The tables above over one data directory, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def _path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def _known(self, name: str) -> tuple[str, str]:
        return self.spark.sparkContext.applicationId, self._path(name)

    def _given(self, name: str) -> DataFrame:
        known = self._known(name)
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(self._path(name)).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(self._path(name))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in GIVEN_TABLES:
            return self._given(name)
        text = STATEMENTS[name]
        return self.spark.sql(text, **{used: self[used] for used in set(_NAME.findall(text))})

    @cached_property
    def tables(self) -> RetailTables:
        return RetailTables(*(self[n] for n in ("ventas", "promociones", "clima", "productos")))


def with_tables(sql: str, parts: dict[str, str]) -> str:
    """``sql`` for DuckDB: each ``{name}`` it uses becomes a common table expression."""
    known = {**STATEMENTS, **parts}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(sql)
    tables = ",\n".join(f"{name} AS ({known[name]})" for name in order)
    statement = f"WITH {tables}\n{sql}" if tables else sql
    return _NAME.sub(r"\1", statement)
