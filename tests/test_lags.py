import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.lags import (
    _lags_per_block,
    add_calendar_lags,
    add_row_lags,
    drop_short_history,
    hot_groups,
)
from shelfcast.schemas import GROUP_KEYS, SALE_COLUMNS

START = datetime.date(2025, 1, 1)
SCHEMA = "fecha date, id_tienda int, id_producto int, unidades_vendidas double, nota string"


def day(n):
    return START + datetime.timedelta(days=n)


def test_golden_twelve_days(frame):
    df = frame([(day(i), 1, 1, float(i + 1), "") for i in range(12)], SCHEMA)
    got = add_row_lags(df).orderBy("fecha").collect()
    assert [r.lag_1 for r in got] == [None, *map(float, range(1, 12))]
    assert [r.lag_7 for r in got] == [None] * 7 + [1.0, 2.0, 3.0, 4.0, 5.0]
    means = [None, 1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6, 7, 8]
    assert [r.media_movil_7 for r in got] == means
    assert drop_short_history(add_row_lags(df)).count() == 5


def test_nan_history_is_dropped(frame):
    df = frame(
        [(1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0), (1.0, None, 1.0)],
        "lag_1 double, lag_7 double, media_movil_7 double",
    )
    assert drop_short_history(df).count() == 1


def brute_row_lags(rows):
    """History of every row by plain list slicing, for rows in a total order."""
    groups = {}
    out = []
    for row in rows:
        past = groups.setdefault(row[1:3], [])
        last = past[-7:]
        out.append(
            (
                *row,
                past[-1] if past else None,
                past[-7] if len(past) >= 7 else None,
                sum(last) / len(last) if last else None,
            )
        )
        past.append(row[3])
    return sorted(out, key=repr)


def crowded(seed, n=400):
    """Few groups, one of them with most rows, and one day of it with a third of all."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            key = (day(5), 1, 1)
        elif i % 3 == 1:
            key = (day(rng.randrange(40)), 1, 1)
        else:
            key = (day(rng.randrange(40)), rng.randrange(3), rng.randrange(2))
        rows.append((*key, float(rng.randrange(100)), f"n{i}"))
    return rows


def in_order(df):
    """Rows in the order the windows use: by day, ties by the digests of sale and row."""
    sale = [c for c in df.columns if c in SALE_COLUMNS]
    ties = {"t": F.xxhash64(*sale), "t2": F.xxhash64(*df.columns)}
    tied = df.withColumns(ties).orderBy("fecha", "t", "t2").drop("t", "t2")
    return [tuple(r) for r in tied.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize(("hot_rows", "block_rows"), [(10**9, 10), (50, 5), (50, 40), (0, 1)])
def test_hot_groups_get_the_same_history(frame, rows, seed, hot_rows, block_rows):
    df = frame(crowded(seed), SCHEMA).repartition(5)
    expected = brute_row_lags(in_order(df))
    assert rows(add_row_lags(df, hot_rows=hot_rows, block_rows=block_rows)) == expected


def test_blocks_stay_small(frame):
    """The final window of the hot path is partitioned by block, and no block is large."""
    df = frame(crowded(4, 3000), SCHEMA)
    plan = _lags_per_block(df, 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # tails are cut down before they are shuffled
    tied = df.withColumn("t", F.xxhash64(*(c for c in df.columns if c in SALE_COLUMNS)))
    crowd = tied.groupBy("fecha", *GROUP_KEYS).count().where("count > 50")
    sliced = (
        tied.join(crowd, ["fecha", *GROUP_KEYS], "left")
        .withColumn("k", F.ceil(F.coalesce("count", F.lit(1)) / 50))
        .withColumn("s", F.floor((F.col("t") / F.lit(2.0**64) + 0.5) * F.col("k")))
    )
    largest = sliced.groupBy("fecha", *GROUP_KEYS, "s").count().agg(F.max("count")).first()[0]
    assert largest < 100


def test_input_order_does_not_matter(frame, rows):
    data = crowded(7)
    shuffled = random.Random(0).sample(data, len(data))
    assert rows(add_row_lags(frame(data, SCHEMA))) == rows(add_row_lags(frame(shuffled, SCHEMA)))


def test_only_hot_groups_are_split(frame, rows):
    df = frame(crowded(1), SCHEMA)
    assert rows(hot_groups(df, 150)) == [(1, 1)]
    assert hot_groups(df, 10**6).isEmpty()


def brute_calendar_lags(data):
    out = []
    for f, t, p, u, note in data:
        same = [(r[0], r[3]) for r in data if r[1:3] == (t, p)]
        ago = lambda n: [u2 for f2, u2 in same if (f - f2).days == n]
        week = [u2 for f2, u2 in same if 1 <= (f - f2).days <= 7]
        mean = sum(week) / len(week) if week else None
        out.append((f, t, p, u, note, max(ago(1), default=None), max(ago(7), default=None), mean))
    return sorted(out, key=repr)


def test_calendar_lags(frame, rows):
    # quarters are exact in any order of adding; the same holds for whole numbers
    data = [(f, t, p, u + (i % 4) / 4, note) for i, (f, t, p, u, note) in enumerate(crowded(5))]
    assert rows(add_calendar_lags(frame(data, SCHEMA))) == brute_calendar_lags(data)


def test_joined_columns_do_not_change_the_order_of_ties(frame, rows):
    df = frame(crowded(6), SCHEMA).drop("nota")
    plain = add_row_lags(df)
    wide = add_row_lags(df.withColumn("temperatura_media", F.rand(1)))
    assert rows(wide.select(*plain.columns)) == rows(plain)


def test_calendar_lags_skip_gaps(frame):
    df = frame([(day(0), 1, 1, 3.0, ""), (day(2), 1, 1, 5.0, ""), (day(9), 1, 1, 7.0, "")], SCHEMA)
    got = add_calendar_lags(df).orderBy("fecha").collect()
    assert [(r.lag_1, r.lag_7, r.media_movil_7) for r in got] == [
        (None, None, None),
        (None, None, 3.0),
        (None, 5.0, 5.0),
    ]


def test_dataset_of_few_columns_is_that_of_all(spark, rows):
    from shelfcast.catalog.fixtures import Fixtures
    from shelfcast.plans.dataset import model_dataset
    from shelfcast.sources.tables import RetailTables

    tables = Fixtures(spark, "/root/testdata/sf0.001").tables
    twice = RetailTables(
        tables.ventas, tables.promociones, tables.clima,
        tables.productos.unionByName(tables.productos.selectExpr(
            "id_producto", "concat(nombre_producto, '2') AS nombre_producto", "categoria")),
    )
    for source in (tables, twice):  # keys of dimensions that repeat multiply the rows
        whole = model_dataset(source)
        for columns in (["id_tienda", "lag_7"], ["descuento_pct", "lluvia_mm", "mes"], ["categoria", "lag_1"]):
            assert rows(model_dataset(source, columns=columns)) == rows(whole.select(*columns))
