"""Sales and promotions stored in buckets of store and product.

Rows of a store and product lie in the same bucket of both tables, so the promotions join and
the history windows read buckets side by side, without an exchange of the sales. Tables are
written to a folder of the shared storage and known to the catalog of the session by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.joins import attach_promotions
from shelfcast.operators.lags import add_row_lags
from shelfcast.schemas import GROUP_KEYS

# Documented parameter: buckets, of about 128 MB each; a task reads one. Both tables of a join
# need the same number.
BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, path: str, *, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` in buckets of store and product, sorted by them and the day, as table
    ``name`` of the session with its files in ``path``, and read it back."""
    (
        df.repartition(buckets, *GROUP_KEYS)  # one file per bucket
        .write.mode("overwrite")
        .bucketBy(buckets, *GROUP_KEYS)
        .sortBy(*GROUP_KEYS, "fecha")
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


@contextmanager
def joins_within_buckets(spark: SparkSession) -> Iterator[None]:
    """Inside the block a join by day, store and product may use a layout by store and product
    alone; plans made there have to be run there, too."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def bucketed_history(sales: DataFrame, promotions: DataFrame, **options: int) -> DataFrame:
    """Promotions and row lags of stored sales; for use inside ``joins_within_buckets``."""
    return add_row_lags(attach_promotions(sales, promotions), **options)
