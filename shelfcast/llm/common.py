"""What several operators share: table reads, words, digests of rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import stage

# Fixed value: a word is a run of characters other than space and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"


# Text that the Python side of an operator takes at a time; what it builds is a multiple of it.
SLICE_BYTES = 2 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def n_words(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform_key(*columns: Column | str, seed: int = 42) -> Column:
    """60 hash bits of the columns as a long: as good as random, the same in every run."""
    digest = F.md5(F.concat_ws("|", *columns, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def crc_bucket(doc_id: Column | str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string")) % buckets


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """At most ``rows`` documents (doc_id, label, text) with a label in ``labels`` (doc_id,
    label): those with the lowest hash of their id, the same in every run. A repeated id
    counts once, with its largest label and its smallest text; null ids and labels do not."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(uniform_key("doc_id", seed=7), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    # the broadcast holds no more than ``rows`` pairs of numbers
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def within_bytes(sample: DataFrame, most_bytes: int) -> DataFrame:
    """The rows of a ``labelled_sample`` that come first in the order of its key and together
    hold no more than ``most_bytes`` of text; texts stay whole. The sample is bounded in rows,
    so one task can add up their sizes."""
    kept = stage(sample, "sample")
    in_order = Window.orderBy(uniform_key("doc_id", seed=7), "doc_id")
    sizes = kept.select("doc_id", F.octet_length("text").cast("long").alias("_bytes"))
    first = sizes.select("doc_id", F.sum("_bytes").over(in_order).alias("_so_far"))
    chosen = first.where(F.col("_so_far") <= most_bytes).select("doc_id")
    return kept.join(F.broadcast(chosen), "doc_id", "left_semi")


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice hold about ``most_bytes``, or one text does:
    what a task builds from a slice then stays small however long the texts are."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False)
        start = held = 0
        for row, length in enumerate(lengths):
            if row > start and held + length > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(length)
        if batch.num_rows > start:
            yield batch.slice(start)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run) -> Run:
    """``run`` for mapInArrow, giving memory back to the machine at the end of a task. Workers
    are kept for later tasks, and what they have freed would else stay with them."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    return wrapped
