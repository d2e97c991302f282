"""Sharding along a Hilbert curve.

Several metadata dimensions are cut into 2^bits cells each at their own quantiles, the cell
coordinates become an index on the Hilbert curve, rows are ordered by it, and the order is cut
into runs of equal row counts. Neighbours on the curve are neighbours in every dimension, so a
shard spans a small box of all of them and its file statistics prune by each. Numbers are cut at
approximate quantiles. Texts are cut by rank: the rows before a value in sorted order are
counted (distinct values with their counts, range sort, prefix sums), so values that begin alike
lie in as many cells as their rows call for. ``write_shards`` writes the runs as files.

Semantics: a null dimension lies in the first cell; ties of the index are ordered by the
dimensions themselves, then by the digest of the text (equal texts of one cell stay together)
and the id; repeated rows take neighbouring slots. An empty table gives an empty result. Law
``rows``: shard s holds the ranks from ceil(s n / k) on, so counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import stage

BITS = 5
SHARDS = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows of ``cells``, each below 2^bits).

    Undoes, level by level from the coarsest, the reflection and exchange of axes that the
    curve makes in the quadrant of a point, then takes the Gray code of the interleaved bits.
    """
    axes = [column.astype(np.int64) for column in cells.T]
    n = len(axes)
    for level in range(bits - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(n):
            set_ = (axes[i] & bit) != 0
            swap = np.where(set_, 0, (axes[0] ^ axes[i]) & below)
            axes[0] = np.where(set_, axes[0] ^ below, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, n):
        axes[i] = axes[i] ^ axes[i - 1]
    carry = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        carry = np.where((axes[-1] & (1 << level)) != 0, carry ^ ((1 << level) - 1), carry)
    axes = [axis ^ carry for axis in axes]
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | ((axis >> level) & 1)
    return index


def value_cells(values: DataFrame, column: str, bits: int) -> DataFrame:
    """Rows (value, cell) for the distinct values of a column: the rows with a smaller value, as
    a share of all rows, times 2^bits. One row per range of values meets in one task."""
    counts = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    ranges = stage(
        counts.agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange("value")
        .withColumn("range", F.spark_partition_id()),
        "shard-values",
    )
    sums = ranges.groupBy("range").agg(F.sum("n").alias("sum"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("at"),
        F.sum("sum").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("at") + F.coalesce("own", F.lit(0))
    return (
        ranges.withColumn("own", F.sum("n").over(inside))
        .join(offsets, "range")
        .select("value", F.floor(before * (1 << bits) / F.col("total")).cast("double").alias("cell"))
    )


def _cell_index(cuts: list[list[float]], bits: int):
    @F.pandas_udf("long")
    def index(dims: pd.DataFrame) -> pd.Series:
        cells = [
            np.where(
                np.isnan(values := dims.iloc[:, i].to_numpy(np.float64)),
                0,
                np.searchsorted(cut, values, side="right"),
            )
            for i, cut in enumerate(cuts)
        ]
        return pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    return index


class _Layout:
    """The order of documents along the curve."""

    def __init__(self, docs: DataFrame, dimensions: Sequence[str], doc_id: str, text: str, bits: int):
        self.doc_id, self.text, self.bits = doc_id, text, bits
        self.dimensions = list(dimensions)
        self.raw = [d for d in dimensions if d != "size"]
        self.texts = {d for d in self.raw if dict(docs.dtypes)[d] == "string"}
        self.order = [
            "_hilbert", *[f"_raw{i}" for i in range(len(self.raw))], "_crc32", "_id", "_size"
        ]
        self.metadata = stage(docs.select(*self._columns()), "shard-metadata")  # texts are read once
        share = [i / (1 << bits) for i in range(1, 1 << bits)]
        numbers = [i for i, d in enumerate(self.dimensions) if d not in self.texts]
        # 2^bits - 1 numbers per dimension, whatever the input
        found = self.metadata.select(
            F.count(F.lit(1)).alias("n"),
            *[F.percentile_approx(self._number(i), share, 1000).alias(f"q{i}") for i in numbers],
        ).first()
        self.total = found["n"]
        cells = [float(c) for c in range(1, 1 << bits)]
        self.cuts = [
            cells if i not in numbers else list(found[f"q{i}"] or [])
            for i in range(len(self.dimensions))
        ]
        self.cells = {
            d: stage(value_cells(self.metadata, f"_raw{self.raw.index(d)}", bits), "shard-cells")
            for d in sorted(self.texts)
        }

    def _columns(self) -> list[Column]:
        size = (F.coalesce(F.octet_length(self.text), F.lit(0)) + 1).cast("long")
        return [
            F.col(self.doc_id).alias("_id"),
            size.alias("_size"),
            F.crc32(F.coalesce(F.col(self.text), F.lit(""))).alias("_crc32"),
            *[F.col(d).alias(f"_raw{i}") for i, d in enumerate(self.raw)],
        ]

    def _number(self, i: int) -> Column:
        name = self.dimensions[i]
        source = "_size" if name == "size" else f"_raw{self.raw.index(name)}"
        return F.col(source).cast("double")

    def indexed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns of the metadata and their place on the curve."""
        dims = []
        for i, name in enumerate(self.dimensions):
            if name in self.texts:
                cell = self.cells[name].select(
                    F.col("value").alias(f"_raw{self.raw.index(name)}"), F.col("cell").alias(f"_dim{i}")
                )
                rows = rows.join(cell, f"_raw{self.raw.index(name)}", "left")
                dims.append(F.col(f"_dim{i}"))
            else:
                dims.append(self._number(i).alias(f"_dim{i}"))
        index = _cell_index(self.cuts, self.bits)(F.struct(*dims))
        return rows.withColumn("_hilbert", index)

    def ranked(self) -> DataFrame:
        """The order columns of every document with its rank (_rank), from 0."""
        ranges = stage(
            self.indexed(self.metadata)
            .repartitionByRange(*self.order)
            .withColumn("_range", F.spark_partition_id())
            .select("_range", *self.order),
            "shard-ranges",
        )
        # one row per range; the first rank of a range is the number of rows before it
        counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        firsts = counts.select(
            "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_at")
        )
        inside = Window.partitionBy("_range").orderBy(*self.order)
        return (
            ranges.withColumn("_in", F.row_number().over(inside) - 1)
            .join(firsts, "_range")
            .withColumn("_rank", F.col("_at") + F.col("_in"))
        )


DIMENSIONS = ("lang", "source", "size")


def hilbert_shards(
    docs: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, size (bytes of the text and one), text_crc32,
    hilbert (index), shard and slot within it. ``size`` may be named as a dimension."""
    layout = _Layout(docs, dimensions, doc_id, text, bits)
    shard = F.expr(f"(_rank * {shards}) div {max(layout.total, 1)}").cast("int")
    start = F.expr(f"(shard * {layout.total}L + {shards - 1}) div {shards}")
    return layout.ranked().withColumn("shard", shard).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc32").alias("text_crc32"),
        F.col("_hilbert").alias("hilbert"),
        "shard",
        (F.col("_rank") - start).cast("long").alias("slot"),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    dimensions: Sequence[str] = DIMENSIONS,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    files: int = 4,
    bits: int = BITS,
) -> None:
    """Write ``docs`` to ``path``/shard=0, 1, ..., about ``files`` files each, every file a run of
    the curve in its order, so that a filter on any of the dimensions skips files by their
    statistics. Rows equal in id, text and dimensions are interchangeable: where a shard begins
    among such rows, all of them go to it."""
    layout = _Layout(docs, dimensions, doc_id, text, bits)
    first = F.expr(f"_rank = (((_rank * {shards}) div {max(layout.total, 1)}) * {layout.total}L + {shards - 1}) div {shards}")
    begins = layout.ranked().where(first).select(*layout.order).orderBy(*layout.order).limit(shards)
    row = F.struct(*layout.order)
    names = [c for c in docs.columns if c != "shard"]
    placed = layout.indexed(docs.select(*names, *layout._columns()))
    # at most ``shards`` rows of metadata; the first shard begins before all rows
    starts = begins.collect()[1:]
    number = F.lit(0)
    for begin in starts:
        values = F.struct(
            *[F.lit(begin[c]).cast(placed.schema[c].dataType).alias(c) for c in layout.order]
        )
        number = number + F.when(row >= values, 1).otherwise(0)
    (
        placed.withColumn("shard", number)
        .repartitionByRange(shards * files, "shard", *layout.order)
        .sortWithinPartitions("shard", *layout.order)
        .select(*names, "shard")
        .write.partitionBy("shard")
        .parquet(path)
    )
