import datetime

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import demand
from shelfcast.functions.calendar import add_calendar
from shelfcast.functions.dates import date_from_parts, date_spine, iso_date, parse_date
from shelfcast.functions.ids import row_id
from shelfcast.operators.metrics import forecast_metrics
from shelfcast.operators.summaries import (
    discount_levels,
    latest,
    mean_units_by,
    newest_first,
    promotion_share,
)
from shelfcast.plans.sizing import sized_shuffles, wanted_partitions


def test_calendar(frame, rows):
    df = frame([("2025-01-05",), ("2025-01-04",), ("2025-01-06",)], "fecha string")
    assert rows(add_calendar(parse_date(df)).drop("fecha")) == [
        (2025, 1, 4, 7, 1),
        (2025, 1, 5, 1, 1),
        (2025, 1, 6, 2, 0),
    ]


def test_bad_dates_become_null(frame):
    df = parse_date(frame([("2025-02-30",), ("x",), ("2025-2-3",)], "fecha string"))
    assert [r.fecha for r in df.collect()] == [None, None, datetime.date(2025, 2, 3)]


def test_date_parts_and_spine(spark, frame):
    df = frame([(2025, 3, 1), (2025, 2, 30)], "y int, m int, d int")
    parts = date_from_parts(F.col("y"), F.col("m"), F.col("d"))
    assert [r[0] for r in df.select(parts).collect()] == [datetime.date(2025, 3, 1), None]
    spine = date_spine(spark, "2025-02-27", "2025-03-01").select(iso_date("fecha"))
    assert [r[0] for r in spine.collect()] == ["2025-02-27", "2025-02-28", "2025-03-01"]


@pytest.mark.parametrize(
    ("base", "rain", "discount", "category", "temperature", "units"),
    [
        (20, 6.0, 10, "Bebidas", 21.0, 22),
        (20, 10.0, 0, "Bebidas", 20.0, 14),
        (20, 10.1, 0, "Higiene", 35.0, 16),
        (20, 5.0, 100, "Higiene", 0.0, 30),
        (-20, 0.0, 0, "Higiene", 0.0, 0),
    ],
)
def test_expected_units(frame, base, rain, discount, category, temperature, units):
    df = frame(
        [(base, rain, discount, category, temperature)], "b int, r double, d int, c string, t double"
    )
    got = demand.expected_units(*(F.col(c) for c in "brdct"))
    assert df.select(got).first()[0] == units


def test_price_and_seasons(spark, frame):
    df = frame([(2.50, 10)], "p double, d int")
    assert df.select(demand.discounted_price(F.col("p"), F.col("d"))).first()[0] == 2.25
    months = spark.range(1, 13).select(
        demand.seasonal_temperature(F.col("id")).alias("t"), demand.seasonal_rain(F.col("id"))
    )
    got = months.collect()
    assert got[0][0] == 10 and abs(got[3][0] - 18) < 1e-9
    assert [r[1] for r in got] == [5] * 5 + [2] * 6 + [5]


def test_row_ids_are_repeatable_and_tell_nulls_apart(frame):
    df = frame([(1, None), (1, ""), (1, "a"), (2, "a"), (1, "-")], "k int, v string")
    first = [r[0] for r in df.select(row_id("r", "k", "v")).collect()]
    assert len(set(first)) == 5
    pairs = frame([("a|1:b", "c"), ("a", "b|1:c")], "k string, v string")
    assert pairs.select(row_id("r", "k", "v")).distinct().count() == 2
    assert first == [r[0] for r in df.select(row_id("r", "k", "v")).collect()]
    assert first != [r[0] for r in df.select(row_id("s", "k", "v")).collect()]


def test_metrics(frame, rows):
    df = frame([(1.0, 2.0), (2.0, 2.0), (6.0, 4.0)], "unidades_vendidas double, prediction double")
    assert rows(forecast_metrics(df)) == [(1.0, 1.291, 0.6429)]
    flat = frame([(2.0, 1.0), (2.0, 3.0)], "unidades_vendidas double, prediction double")
    assert rows(forecast_metrics(flat)) == [(1.0, 1.0, None)]


def test_summaries(frame, rows):
    df = frame(
        [(1, 1, 10, 4.0), (1, 0, 0, 2.0), (2, 0, 0, 5.0)],
        "id_tienda int, promocion_activa int, descuento_pct int, unidades_vendidas double",
    )
    assert rows(mean_units_by(df, "id_tienda")) == [(1, 3.0), (2, 5.0)]
    assert rows(promotion_share(df)) == [(1, 100 / 3)]
    assert rows(promotion_share(df.where("id_tienda > 5"))) == [(0, None)]
    assert rows(discount_levels(df)) == [(10,)]


def test_latest(frame):
    df = frame([(i // 2, i) for i in range(10)], "t int, id int")
    assert [r.id for r in latest(df, "t", 3).collect()] == [9, 8, 7]
    assert [r.id for r in newest_first(df, "t").collect()] == list(range(9, -1, -1))
    plan = latest(df, "t", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_shuffle_size_follows_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    paths = ["/root/testdata/sf0.001/lineitem.parquet"]
    with sized_shuffles(spark, paths) as n:
        assert n == 4 and spark.conf.get(key, None) is None
    with sized_shuffles(spark, paths, partition_bytes=10_000) as n:
        assert n == 12 and spark.conf.get(key) == "12"
    assert spark.conf.get(key, None) is None
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        with sized_shuffles(spark, paths, partition_bytes=5_000):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert wanted_partitions(spark, paths, 1) > 100_000  # no upper bound
