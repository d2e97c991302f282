"""A corpus pipeline: stages that each read what the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the ``docs`` of the next. All but the last return the columns of documents.

1. toxicity: rejects documents by the clause grammar, learned from the labels in ``sf_dir``.
2. near-duplicates: keeps the document with the smallest id of each group (five words, 0.8).
3. personal data: replaces what the redactor finds and counts the characters anew.
4. mixing: cuts or repeats each source to its target share of words.
5. encoding: ids of the SentencePiece model, verified and decoded back.

Null texts pass the stages as empty documents until the mix, which takes no words of them. An
empty table gives an empty result. Columns beyond those of documents are carried along.

Executors keep their Python workers from stage to stage, so texts go to them ``ARROW_ROWS`` rows
at a time: the stages lower the session's Arrow batches to that, never raise them.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import minhash, mixing, pii, sentences, toxicity
from shelfcast.llm.common import crc_bucket, read
from shelfcast.sources.staging import stage_result

ARROW_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """A stage is written after its function has returned, so the setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(setting))
    if rows <= 0 or rows > ARROW_ROWS:  # not positive: unlimited
        spark.conf.set(setting, str(ARROW_ROWS))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    labels = read(spark, sf_dir, "labels").where(crc_bucket("doc_id", 4) != 2)
    model = toxicity.fit_toxicity(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, minhash.near_duplicates(docs, n=5))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redactor = pii.fit_redactor(docs)
    found = pii.find_spans(docs, redactor, base="__pii_base", every="__pii_spans")
    clean = found.withColumn("text", pii.redact(F.col("text"), F.col("__pii_spans")))
    return _recount(clean).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(mixing.take_mix(docs, mixing.mix_sources(docs, digest=True)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    # executors still hold what the stages before took; fewer remembered words leave them room
    return sentences.encode_documents(docs, cached_words=100_000)


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", reject_toxic),
    ("near-duplicates", drop_copies),
    ("personal data", redact_personal_data),
    ("mixing", mix),
    ("encoding", encode),
]

# A learned filter, near-duplicates and a tokenizer cannot be stated in SQL; tests/llm holds
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        build = partial(step, spark, docs, sf_dir)
        docs = stage_result(spark, build, f"pipeline-{name.replace(' ', '-')}")
    return docs
