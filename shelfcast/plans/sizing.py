"""Number of shuffle partitions from the size of the input."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 256 * 1024 * 1024


def wanted_partitions(
    spark: SparkSession, paths: list[str], partition_bytes: int = PARTITION_BYTES
) -> int:
    """Partitions of about ``partition_bytes`` for the files under ``paths``. Only file lengths
    are read; they are those of compressed files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    total = files.agg(F.sum("length")).first()[0] or 0
    return math.ceil(total / partition_bytes)


@contextmanager
def sized_shuffles(
    spark: SparkSession, paths: list[str], partition_bytes: int = PARTITION_BYTES
) -> Iterator[int]:
    """Inside the block shuffles start with enough partitions for the files under ``paths``.

    Adaptive execution merges partitions that turn out small but splits none outside of
    joins, so the initial number has to follow the input. It is raised where the session's
    own number is too small, never lowered, and put back at the end of the block. Jobs of
    the block have to run inside of it.
    """
    wanted = wanted_partitions(spark, paths, partition_bytes)
    setting = "spark.sql.shuffle.partitions"
    current = int(spark.conf.get(setting))
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        current = int(spark.conf.get(setting, None) or current)
    before = spark.conf.get(setting, None)
    if wanted > current:
        spark.conf.set(setting, str(wanted))
    try:
        yield max(wanted, current)
    finally:
        if wanted > current:
            if before is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, before)
