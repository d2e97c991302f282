"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import calendar
from shelfcast.functions import demand
from shelfcast.functions.calendar import add_calendar
from shelfcast.functions.dates import date_from_parts, days_between, iso_date
from shelfcast.functions.ids import row_id
from shelfcast.plans.dataset import model_dataset


@query("calendar_features", calendar("{ventas}"))
def _(fx):
    return add_calendar(fx["ventas"])


@query(
    "conditional_expressions",
    """SELECT fecha, id_tienda, id_producto,
       CASE WHEN unidades_vendidas IS NULL THEN 'nulo' WHEN unidades_vendidas < 0 THEN 'negativo'
            ELSE 'valido' END AS estado,
       coalesce(unidades_vendidas, 0) AS unidades, id_tienda IN (1, 7) AS es_miembro,
       precio_unitario BETWEEN 0 AND 100 AS en_rango, precio_unitario IS NULL AS sin_precio
FROM {ventas_sucias}""",
)
def _(fx):
    units, price = F.col("unidades_vendidas"), F.col("precio_unitario")
    return fx["ventas_sucias"].select(
        "fecha",
        "id_tienda",
        "id_producto",
        F.when(units.isNull(), "nulo").when(units < 0, "negativo").otherwise("valido").alias("estado"),
        F.coalesce(units, F.lit(0)).alias("unidades"),
        F.col("id_tienda").isin(1, 7).alias("es_miembro"),
        price.between(0, 100).alias("en_rango"),
        price.isNull().alias("sin_precio"),
    )


@query(
    "date_functions",
    """SELECT fecha, id_tienda, id_producto, strftime(fecha, '%Y-%m-%d') AS texto,
       fecha AS desde_partes,
       TRY_CAST(concat(year(fecha), '-', lpad(CAST(month(fecha) AS VARCHAR), 2, '0'), '-31')
                AS DATE) AS fin_de_mes
FROM {ventas}""",
)
def _(fx):
    year, month, day = F.year("fecha"), F.month("fecha"), F.dayofmonth("fecha")
    return fx["ventas"].select(
        "fecha",
        "id_tienda",
        "id_producto",
        iso_date("fecha").alias("texto"),
        date_from_parts(year, month, day).alias("desde_partes"),
        date_from_parts(year, month, F.lit(31)).alias("fin_de_mes"),
    )


@query(
    "date_spine",
    """SELECT CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS fecha
FROM {ventas}""",
)
def _(fx):
    ends = fx["ventas"].agg(F.min("fecha").alias("first"), F.max("fecha").alias("last"))
    return ends.select(F.explode(days_between(F.col("first"), F.col("last"))).alias("fecha"))


# A decimal of the printed value rounds halves as Spark does; rounding the binary value does not.
def _rounded(expression: str, places: int) -> str:
    exact = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(round({exact}, {places}) AS DOUBLE)"


@query(
    "rounding",
    f"""SELECT fecha, id_tienda, id_producto, {_rounded("precio_unitario", 1)} AS r1,
       {_rounded("precio_unitario", 2)} AS r2, {_rounded("precio_unitario", 4)} AS r4
FROM {{ventas}}""",
)
def _(fx):
    rounded = [F.round("precio_unitario", n).alias(f"r{n}") for n in (1, 2, 4)]
    return fx["ventas"].select("fecha", "id_tienda", "id_producto", *rounded)


@query(
    "clamp_and_truncate",
    """SELECT fecha, id_tienda, id_producto, greatest(0, unidades_vendidas) AS unidades,
       CAST(trunc(precio_unitario) AS INTEGER) AS precio_entero
FROM {ventas_sucias}""",
)
def _(fx):
    return fx["ventas_sucias"].select(
        "fecha",
        "id_tienda",
        "id_producto",
        demand.clamp_at_zero(F.col("unidades_vendidas")).alias("unidades"),
        F.col("precio_unitario").cast("int").alias("precio_entero"),
    )


_INPUTS = """(SELECT fecha, id_tienda, id_producto, unidades_vendidas, precio_unitario,
    descuento_pct, temperatura_media, lluvia_mm,
    CASE WHEN id_producto % 2 = 0 THEN 'Bebidas' ELSE categoria END AS categoria
  FROM {rellenas}) x"""
_RAIN = "CASE WHEN lluvia_mm > 10 THEN 0.8 WHEN lluvia_mm > 5 THEN 0.9 ELSE 1.0 END::DOUBLE"
_PROMO = "(1.0::DOUBLE + (descuento_pct::DOUBLE / 100) * 0.5::DOUBLE)"
_TEMPERATURE = """CASE WHEN categoria = 'Bebidas'
    THEN CASE WHEN temperatura_media > 20 THEN 1.2 ELSE 0.8 END ELSE 1.0 END::DOUBLE"""


def _demand_inputs(fx):
    """Joined sales with weather and promotion; every other product stands for a drink."""
    drink = F.col("id_producto") % 2 == 0
    return model_dataset(fx.tables, full_history_only=False).withColumn(
        "categoria", F.when(drink, demand.DRINKS).otherwise(F.col("categoria"))
    )


@query(
    "demand_factors",
    f"""SELECT fecha, id_tienda, id_producto, CASE WHEN descuento_pct > 0 THEN 1 ELSE 0 END AS promo,
       {_RAIN} AS f_lluvia, {_PROMO} AS f_promo, {_TEMPERATURE} AS f_temp
FROM {_INPUTS}""",
)
def _(fx):
    discount = F.col("descuento_pct")
    return _demand_inputs(fx).select(
        "fecha",
        "id_tienda",
        "id_producto",
        demand.promotion_flag(discount).alias("promo"),
        demand.rain_factor(F.col("lluvia_mm")).alias("f_lluvia"),
        demand.promotion_factor(discount).alias("f_promo"),
        demand.temperature_factor(F.col("categoria"), F.col("temperatura_media")).alias("f_temp"),
    )


@query(
    "expected_units",
    f"""SELECT fecha, id_tienda, id_producto,
       greatest(0, CAST(trunc(unidades_vendidas * {_RAIN} * {_PROMO} * {_TEMPERATURE})
                        AS INTEGER)) AS unidades_esperadas
FROM {_INPUTS}""",
)
def _(fx):
    units = demand.expected_units(
        *(
            F.col(c)
            for c in (
                "unidades_vendidas",
                "lluvia_mm",
                "descuento_pct",
                "categoria",
                "temperatura_media",
            )
        )
    )
    return _demand_inputs(fx).select(
        "fecha", "id_tienda", "id_producto", units.alias("unidades_esperadas")
    )


@query(
    "discounted_price",
    f"""SELECT fecha, id_tienda, id_producto,
       {_rounded("precio_unitario * (1 - descuento_pct::DOUBLE / 100)", 2)} AS precio
FROM {_INPUTS}""",
)
def _(fx):
    price = demand.discounted_price(F.col("precio_unitario"), F.col("descuento_pct"))
    return _demand_inputs(fx).select("fecha", "id_tienda", "id_producto", price.alias("precio"))


@query(
    "seasonal_curves",
    """SELECT fecha, round(10 + 8 * sin(2 * pi() * (month(fecha) - 1) / 12), 9) AS temperatura,
       CASE WHEN month(fecha) IN (12, 1, 2, 3, 4, 5) THEN 5 ELSE 2 END AS lluvia
FROM {clima}""",
)
def _(fx):
    month = F.month("fecha")
    return fx["clima"].select(
        "fecha",
        F.round(demand.seasonal_temperature(month), 9).alias("temperatura"),
        demand.seasonal_rain(month).alias("lluvia"),
    )


@query(
    "numeric_functions",
    """SELECT fecha, id_tienda, id_producto, abs(unidades_vendidas) AS absoluto,
       unidades_vendidas ** 2 AS cuadrado, sqrt(abs(unidades_vendidas)) AS raiz,
       CAST(id_tienda AS DOUBLE) AS decimal
FROM {ventas_sucias}""",
)
def _(fx):
    units = F.col("unidades_vendidas")
    return fx["ventas_sucias"].select(
        "fecha",
        "id_tienda",
        "id_producto",
        F.abs(units).alias("absoluto"),
        F.pow(units, F.lit(2)).alias("cuadrado"),
        F.sqrt(F.abs(units)).alias("raiz"),
        F.col("id_tienda").cast("double").alias("decimal"),
    )


@query(
    "run_row_ids",
    """SELECT fecha, id_tienda, id_producto,
       md5(concat_ws('|', 'r1', '10:' || CAST(fecha AS VARCHAR),
         length(CAST(id_tienda AS VARCHAR)) || ':' || id_tienda,
         length(CAST(id_producto AS VARCHAR)) || ':' || id_producto)) AS id,
       TRUE AS fechado
FROM {ventas}""",
)
def _(fx):
    keys = ("fecha", "id_tienda", "id_producto")
    return fx["ventas"].select(
        *keys, row_id("r1", *keys).alias("id"), F.current_timestamp().isNotNull().alias("fechado")
    )
