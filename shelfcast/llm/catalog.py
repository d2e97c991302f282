"""The registered queries of this subpackage and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    bytenet,
    chat,
    interactions,
    minhash,
    mixing,
    mtree,
    pii,
    repair,
    rules,
    sentences,
    sharding,
    toxicity,
    vectors,
)
from shelfcast.llm.common import crc_bucket, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 4) == 2
    labels = read(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit_toxicity(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentences.encode_documents(read(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        "n_bytes",
        "parity",
        "round_trip",
    )


@query("op3_vectors")
def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


@query("op4_chat_formatting", chat.SQL)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    rows = (
        read(spark, sf_dir, "conversations")
        .select("conv_id", "turn", "role", "text")
        .unionByName(added)
    )
    messages = rows.withColumn("parts", chat.text_parts("text"))
    back = chat.read_chat(chat.format_chat(messages))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), n=2)


@query("op6_mixing", mixing.SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.hilbert_shards(read(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.find_spans(docs, pii.fit_redactor(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)],
        F.sha2(pii.span_list("pii_base"), 256).alias("base_sha256"),
        pii.span_list("pii_spans").alias("spans"),
    )


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 3) == 1
    labels = read(spark, sf_dir, "labels").where(~held_out)
    model = bytenet.fit_quality(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return bytenet.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return rules.apply_rules(docs, rules.fit_rules(docs, labels))


@query("op11_filter_audit", interactions.SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit_filters(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    )


@query("op12_conversation_repair", repair.SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return repair.repair_report(rows, repair.in_order(repair.damage(rows)))


@query("op13_top_k", mtree.SQL)
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
