import bisect
import math
import random
import zlib
from glob import glob

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelfcast.llm.sharding import hilbert_index, hilbert_shards, value_cells, write_shards


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1)
        cells = grid.reshape(-1, dims)
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def rows(n=203):
    return [(i, "x" * (i * 7 % 90), "hot" if i % 3 else f"s{i % 17}") for i in range(n)]


def test_counts_slots_and_digests(documents):
    for n in (203, 8, 5, 1):
        got = hilbert_shards(documents(rows(n))).collect()
        counts = [sum(r.shard == s for r in got) for s in range(8)]
        assert sum(counts) == n and max(counts) - min(counts) <= 1
        for s in range(8):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
        texts = {i: t for i, t, _ in rows(n)}
        assert all(r.size == len(texts[r.doc_id]) + 1 for r in got)
        assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)


def test_shards_follow_the_curve_and_do_not_depend_on_partitions(documents):
    one = hilbert_shards(documents(rows())).collect()
    two = hilbert_shards(documents(rows(), partitions=7)).collect()
    assert sorted(one) == sorted(two)
    order = sorted(one, key=lambda r: (r.shard, r.slot))
    assert all(a.hilbert <= b.hilbert for a, b in zip(order, order[1:], strict=False))


def test_nulls_repeated_rows_and_empty_table(documents):
    df = documents([(1, None), (1, None), (None, ""), (2, "é😀"), (3, "b", None)])
    got = hilbert_shards(df).collect()
    assert sorted(r.size for r in got) == [1, 1, 1, 2, 7]
    assert sorted(r.shard for r in got) == [0, 1, 3, 4, 6] and {r.slot for r in got} == {0}
    assert hilbert_shards(df.limit(0)).collect() == []


def documents_like_a_crawl(spark, n=600, partitions=3):
    """Sources with a long common beginning, one of them a third of all rows; some nulls."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        source = "https://common-crawl/hot" if i % 3 == 0 else f"https://common-crawl/{rng.randrange(40):02d}"
        lang = rng.choice(["en", "de", "fr", None])
        text = rng.choice("ab") * rng.randrange(400)
        rows.append((rng.randrange(500), text, lang, source if i % 50 else None, len(text)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return rows, spark.createDataFrame(rows, schema).repartition(partitions)


def brute_shards(rows, shards=8, bits=5):
    """Cells, index, rank and shard of every row, one by one."""
    def text_cells(values):
        known = sorted(v.encode() for v in values if v is not None)
        return [0 if v is None else bisect.bisect_left(known, v.encode()) * (1 << bits) // len(known) for v in values]

    sizes = [len((r[1] or "").encode()) + 1 for r in rows]
    ordered, n = sorted(sizes), len(rows)
    cuts = [ordered[math.ceil(i / (1 << bits) * n) - 1] for i in range(1, 1 << bits)]
    cells = np.stack(
        [text_cells([r[2] for r in rows]), text_cells([r[3] for r in rows]),
         [bisect.bisect_right(cuts, s) for s in sizes]], axis=1)
    index = hilbert_index(cells, bits)
    keys = [
        (int(h), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""),
         zlib.crc32((r[1] or "").encode()), r[0], s)
        for h, r, s in zip(index, rows, sizes, strict=True)
    ]
    return [(k[4], k[5], k[3], k[0], rank * shards // n) for rank, k in enumerate(sorted(keys))]


def test_shards_equal_brute_force(spark):
    rows, df = documents_like_a_crawl(spark)
    got = [(r.doc_id, r.size, r.text_crc32, r.hilbert, r.shard) for r in hilbert_shards(df).collect()]
    assert sorted(got) == sorted(brute_shards(rows))


def test_values_that_begin_alike_get_cells_of_their_own(spark):
    rows, df = documents_like_a_crawl(spark)
    cells = {r.value: r.cell for r in value_cells(df, "source", 5).collect()}
    assert len(cells) == 41 and len(set(cells.values())) > 15
    values = sorted(cells)
    assert [cells[v] for v in values] == sorted(cells.values()) and cells[values[0]] == 0
    assert value_cells(df.limit(0), "source", 5).collect() == []


def files_with(path, column, value):
    """Files whose footer statistics do not rule the value out."""
    hit, every = 0, glob(f"{path}/**/*.parquet", recursive=True)
    for name in every:
        meta = pq.read_metadata(name)
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s is None or (s.has_min_max and s.min <= value <= s.max) for s in stats)
    return hit, len(every)


def test_files_are_skipped_by_every_dimension(spark, tmp_path):
    rows, df = documents_like_a_crawl(spark, 3_000)
    sharded, plain = str(tmp_path / "sharded"), str(tmp_path / "plain")
    write_shards(df, sharded)
    df.repartition(32).write.parquet(plain)
    back = spark.read.parquet(sharded)
    assert sorted(map(repr, back.drop("shard").collect())) == sorted(map(repr, df.collect()))
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 3  # copies are not told apart
    for column, value in (("lang", "fr"), ("source", "https://common-crawl/07"), ("n_chars", 390)):
        hit, every = files_with(sharded, column, value)
        other, of = files_with(plain, column, value)
        assert every >= 24 and of == 32
        assert hit <= every * 0.6 and hit < other, column
    hits = {f.split("/")[-1] for f in back.where("lang = 'fr' AND n_chars > 380").select(
        F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert len(hits) <= every * 0.4


def test_write_nothing_and_very_long_texts(spark, documents, tmp_path):
    df = documents([(1, "x" * 2_000_000), (2, "y"), (2, "y"), (None, None)])
    write_shards(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    write_shards(df.limit(0), str(tmp_path / "b"))
    sizes = sorted(r.size for r in hilbert_shards(df).collect())
    assert sizes == [1, 2, 2, 2_000_001]
