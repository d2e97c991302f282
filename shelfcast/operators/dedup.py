"""Duplicates: whole rows, keys, appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import BROADCAST_BYTES
from shelfcast.sources.staging import stage

_DIGEST_BYTES = 48  # two longs in a hashed relation


def drop_identical_rows(df: DataFrame) -> DataFrame:
    """One row of every set of rows equal in all columns (NULLs count as equal).
    Copies collapse in the map-side half of the aggregate, before the shuffle."""
    return df.dropDuplicates()


def drop_identical_wide_rows(df: DataFrame, *, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The same result for wide rows of which few are copies. Only digests of 128 bits are
    shuffled; rows whose digest occurs once stay where they are, the others are compared in
    full. ``df`` is read three times, best from a stored table. Where the repeated digests take
    more than ``limit`` bytes, so that they cannot be broadcast, all rows are compared."""
    digest = {"_d1": F.xxhash64(F.lit(1), *df.columns), "_d2": F.xxhash64(F.lit(2), *df.columns)}
    marked = df.withColumns(digest)
    keys = list(digest)
    counts = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counts.where("_n > 1").select(*keys), "repeated-digests")
    if repeated.count() * _DIGEST_BYTES > limit:
        return drop_identical_rows(df)
    few = F.broadcast(repeated)  # measured above
    once = marked.join(few, keys, "left_anti").select(*df.columns)
    copies = marked.join(few, keys, "left_semi").select(*df.columns)
    return once.unionByName(drop_identical_rows(copies))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of every key by ``order``; ties go to the smaller remaining columns. A value
    comes before NULL.

    An aggregate rather than a ranking window: a hot key shrinks to one row before the
    shuffle, and the planner knows that the keys of the result are unique. Structs cannot be
    kept in a hash aggregate, so it is planned as a sort aggregate with a sort before the
    shuffle; where one column is wanted, min or max of it is cheaper.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [*order, *(c for c in rest if c not in order)]
    if not rest:
        return df.dropDuplicates()
    nulls_last = [x for c in rank for x in (F.col(c).isNull(), F.col(c))]
    first = F.min_by(F.struct(*rest), F.struct(*nulls_last)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("filas")).where("filas > 1")


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both tables, duplicates kept."""
    return existing.unionByName(new)


def append_unique(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables with one row per key; existing rows win over new ones."""
    ranked = append_rows(
        existing.withColumn("_origin", F.lit(0)), new.withColumn("_origin", F.lit(1))
    )
    return first_per_key(ranked, keys, ["_origin"]).drop("_origin")
