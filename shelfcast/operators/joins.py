"""Left joins of sales with promotions, weather and products; look-ups and the day grid.

No side is broadcast unseen. Weather and products are measured first, and only a side
within a byte limit gets the hint; above it the join stays a shuffled one, which adaptive
execution splits where a key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfcast.functions.dates import days_between
from shelfcast.schemas import SALE_KEYS
from shelfcast.sources.tables import RetailTables

BROADCAST_BYTES = 64 * 1024 * 1024
_SLOT_BYTES = 16  # fixed-width value plus its share of row overhead


@dataclass(frozen=True)
class Dimension:
    """The right side of a left join, after a look at its size and keys."""

    rows: DataFrame
    key: str
    unique: bool  # no key occurs twice, so the join keeps the number of rows


def _profile(df: DataFrame, key: str) -> DataFrame:
    """One row: number of rows, of rows of the most frequent key, and of text bytes."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    per_key = df.groupBy(key).agg(F.count("*").alias("n"), F.sum(length).alias("text"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most"),
        F.coalesce(F.sum("text"), F.lit(0)).alias("text"),
    )


def measure(*sides: tuple[DataFrame, str], limit: int = BROADCAST_BYTES) -> list[Dimension]:
    """Dimensions of (table, key) pairs, broadcast where they fit ``limit``; one job for all."""
    profiles = [
        _profile(df, key).withColumn("side", F.lit(i)) for i, (df, key) in enumerate(sides)
    ]
    found = {row.side: row for row in reduce(DataFrame.unionByName, profiles).collect()}
    dimensions = []
    for i, (df, key) in enumerate(sides):
        size = found[i].rows * _SLOT_BYTES * (len(df.columns) + 1) + found[i].text
        rows = F.broadcast(df) if size <= limit else df
        dimensions.append(Dimension(rows, key, unique=found[i].most <= 1))
    return dimensions


def attach(df: DataFrame, *dimensions: Dimension) -> DataFrame:
    """Every row of ``df`` with its match in each dimension, NULLs where there is none."""
    for dimension in dimensions:
        df = df.join(dimension.rows, dimension.key, "left")
    return df


def attach_promotions(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Both sides grow with the sales, so the strategy is left to the planner."""
    return sales.join(promotions, list(SALE_KEYS), "left")


def attach_weather(df: DataFrame, weather: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return attach(df, *measure((weather, "fecha"), limit=limit))


def attach_products(df: DataFrame, products: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return attach(df, *measure((products, "id_producto"), limit=limit))


def merge_tables(tables: RetailTables, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Every sale with its promotion, weather and product, where there are such.
    A key that occurs twice on the right gives two rows."""
    dimensions = measure((tables.clima, "fecha"), (tables.productos, "id_producto"), limit=limit)
    return attach(attach_promotions(tables.ventas, tables.promociones), *dimensions)


def lookup_discount(df: DataFrame, promotions: DataFrame) -> DataFrame:
    """Smallest discount among the promotions of the key, 0 where there is none."""
    discounts = promotions.groupBy(*SALE_KEYS).agg(F.min("descuento_pct").alias("descuento_pct"))
    return df.join(discounts, list(SALE_KEYS), "left").withColumn(
        "descuento_pct", F.coalesce("descuento_pct", F.lit(0))
    )


def lookup_category(df: DataFrame, products: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Smallest category among the rows of the product; unknown products are left out."""
    categories = products.groupBy("id_producto").agg(F.min("categoria").alias("categoria"))
    (side,) = measure((categories, "id_producto"), limit=limit)
    return df.join(side.rows, side.key)


def lookup_base_price(df: DataFrame, prices: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """List price of the product, NULL where the price table has none."""
    return attach(df, *measure((prices, "id_producto"), limit=limit))


def products_without_price(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Products of ``df`` that the price table misses."""
    return df.select("id_producto").distinct().join(prices, "id_producto", "left_anti")


def day_grid(
    products: DataFrame, first: str | Column, last: str | Column, stores: int = 3
) -> DataFrame:
    """Every day, store and product: each product row is expanded in place, no join is run."""
    return (
        products.select("id_producto")
        .withColumn("id_tienda", F.explode(F.sequence(F.lit(1), F.lit(stores))))
        .withColumn("fecha", F.explode(days_between(first, last)))
        .select(*SALE_KEYS)
    )
