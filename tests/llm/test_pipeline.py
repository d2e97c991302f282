"""The stages one by one over small documents, and the registered queries against their SQL."""

import random
from glob import glob
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from shelfcast.llm import catalog
from shelfcast.llm.mixing import mix_sources
from tests.llm.test_minhash import brute_force

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with toxic, repeated, personal, null and empty rows."""
    rng = random.Random(8)
    syllables = ["ra", "mi", "tol", "sen", "ku", "ble", "no"]
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(70)]
        toxic = i % 9 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(70)] = "grobl" + rng.choice(["ar", "ek", "i"])
        if i % 5 == 1:
            words[10] = f"a{i}@mail.example.org"
        rows.append((i, " ".join(words), "en", rng.choice(["a", "b", "b", "c", None])))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + k, rows[k][1] + " " + str(k), "en", "a") for k in range(1, 60, 4)]
    rows += [(2000, None, "en", "a"), (2001, "", None, "b"), (2002, None, "en", None), rows[4]]
    path = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("kept", F.lit(9))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES[:4]:
        before = docs
        step(spark, before, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        seen[name] = (before.collect(), docs.collect())

    before, after = seen["toxicity"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} >= set(range(0, 300, 9))
    assert len({r.doc_id for r in after if r.doc_id < 300}) == 300 - len(range(0, 300, 9))

    before, after = seen["near-duplicates"]
    expected = {i for i, (_, c) in brute_force([(r.doc_id, r.text) for r in before], 5).items() if i == c}
    assert sorted(r.doc_id for r in after) == sorted(expected)

    before, after = seen["personal data"]
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        assert "@" not in (r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
        if "@" not in (texts[r.doc_id] or ""):
            assert r.text == texts[r.doc_id]
        else:
            assert "<EMAIL>" in r.text

    before, after = seen["mixing"]
    input_ = spark.createDataFrame(before, f"{', '.join(f'{c} {t}' for c, t in docs.dtypes)}")
    taken = {r.doc_id: r.taken for r in mix_sources(input_).collect()}
    words = dict.fromkeys(taken, 0)
    for r in after:
        words[r.doc_id] += len(r.text.split())
    assert words == taken


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and all(r.parity and r.round_trip and r.ids is not None for r in out)


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        out = step(spark, docs, folder)
        assert out.collect() == []


def test_registered():
    names = entry_point.queries()
    assert set(catalog.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 11))
    assert set(catalog.ORACLES) == {"op4_chat_formatting", "op6_mixing"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    result = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    rows = sorted(tuple(r[c] for c in columns) for r in df.collect())
    assert rows == sorted(result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_covers_its_table(spark, duck, name):
    out = catalog.QUERIES[name](spark, SF_DIR).collect()
    key = "vec_id" if name.startswith("op3") else "doc_id"
    table = "embeddings" if name.startswith("op3") else "documents"
    ids = duck.execute(f"SELECT {key} FROM {table}").fetchall()
    assert sorted((r[key],) for r in out) == sorted(ids)


def test_texts_go_to_python_in_small_batches(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        for given, kept in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            spark.conf.set(setting, given)
            corpus_pipeline.encode(spark, docs, folder)
            assert spark.conf.get(setting) == kept
    finally:
        spark.conf.set(setting, before)
