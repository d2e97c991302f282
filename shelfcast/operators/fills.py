"""Filling the gaps that the left joins leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import approximate_quantile, discrete_quantile

# No promotion, no discount, no rain.
ZERO_FILLED = ("promocion_activa", "descuento_pct", "lluvia_mm")


def fill_zeros(df: DataFrame) -> DataFrame:
    present = [c for c in ZERO_FILLED if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in present})


def fill_temperature(
    df: DataFrame, *, over: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    """Missing temperatures become the median over all rows; without any they stay NULL.

    ``over`` are the rows the median is taken of, ``df`` itself by default. The median is a
    scalar subquery: it is part of the same plan, and no job runs here.
    """
    if "temperatura_media" not in df.columns:
        return df
    quantile = discrete_quantile if exact else approximate_quantile
    median = quantile(df if over is None else over, "temperatura_media", 0.5).scalar()
    return df.withColumn("temperatura_media", F.coalesce("temperatura_media", median))


def fill_missing(
    df: DataFrame, *, over: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    return fill_temperature(fill_zeros(df), over=over, exact=exact)
