"""Row identities for audit tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import stage


def row_id(run_id: Column | str, *columns: str) -> Column:
    """128-bit id of a row of a run. Unlike a serial number a digest needs no coordination and
    is the same when a task runs again."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    texts = [F.col(c).cast("string") for c in columns]
    # with its length before it, a value cannot run into the next, and NULL differs from ''
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", run, *parts))


def with_serial(
    df: DataFrame, order: Sequence[str], *, first: int = 1, name: str = "id"
) -> DataFrame:
    """``df`` with numbers ``first``, ``first`` + 1, ... in the order of ``order``, without gaps;
    rows equal in it are numbered in any order. Rows are cut into sorted ranges and stored with
    their place in the range; what meets in one task is one count per range."""
    rest = [c for c in df.columns if c not in order]
    place = F.monotonically_increasing_id()  # range in the upper bits, place in the lower 33
    ranges = stage(
        df.repartitionByRange(*order, *rest)
        .sortWithinPartitions(*order, *rest)
        .withColumns({"_place": place.bitwiseAND((1 << 33) - 1), "_range": F.spark_partition_id()}),
        "serial-ranges",
    )
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_at"))
    number = F.col("_at") + F.col("_place") + first
    return ranges.join(offsets, "_range").withColumn(name, number).select(*df.columns, name)
