"""Business summaries over sales, promotions, weather and audit tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import TARGET
from shelfcast.sources.tables import RetailTables


def mean_units_by(df: DataFrame, column: str) -> DataFrame:
    """Mean units sold per value of ``column``, e.g. the store or the promotion flag."""
    return df.groupBy(column).agg(F.avg(TARGET).alias("media_unidades"))


def row_counts(tables: RetailTables) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.as_dict().items()
    ]
    return reduce(DataFrame.unionByName, counts)


def weather_ranges(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.min("temperatura_media").alias("temperatura_min"),
        F.max("temperatura_media").alias("temperatura_max"),
        F.min("lluvia_mm").alias("lluvia_min"),
        F.max("lluvia_mm").alias("lluvia_max"),
    )


def sales_ranges(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.min(TARGET).alias("unidades_min"),
        F.max(TARGET).alias("unidades_max"),
        F.avg(TARGET).alias("unidades_media"),
        F.min("precio_unitario").alias("precio_min"),
        F.max("precio_unitario").alias("precio_max"),
    )


def promotion_share(promotions: DataFrame) -> DataFrame:
    """Number of active promotions and their share of all rows in percent."""
    active = F.count_if(F.col("promocion_activa") == 1)
    return promotions.agg(
        active.alias("activas"),
        F.try_divide(100 * active, F.count("*")).alias("porcentaje"),
    )


def discount_levels(promotions: DataFrame) -> DataFrame:
    return promotions.where("descuento_pct > 0").select("descuento_pct").distinct()


def latest(df: DataFrame, column: str, n: int, tie_break: str = "id") -> DataFrame:
    """The ``n`` newest rows: every task keeps n, no full sort."""
    return df.orderBy(F.desc(column), F.desc(tie_break)).limit(n)


def newest_first(df: DataFrame, column: str, tie_break: str = "id") -> DataFrame:
    return df.orderBy(F.desc(column), F.desc(tie_break))
