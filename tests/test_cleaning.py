import datetime

from shelfcast.operators.cleaning import clean_table
from shelfcast.operators.dedup import (
    append_rows,
    append_unique,
    drop_identical_rows,
    first_per_key,
    repeated_keys,
)

DAY = datetime.date(2025, 1, 3)
SALES = "fecha string, id_tienda int, id_producto int, unidades_vendidas int, precio_unitario double"
PROMOTIONS = "fecha string, id_tienda int, id_producto int, promocion_activa int, descuento_pct int"


def test_sales_lose_invalid_rows(frame, rows):
    df = frame(
        [
            ("2025-01-03", 1, 1, 5, 2.0),
            ("2025-01-03", 1, 1, 5, 2.0),  # copy
            ("2025-1-3", 1, 2, 0, 0.0),  # both bounds are inclusive
            ("bad", 1, 3, 5, 2.0),
            ("2025-13-01", 1, 4, 5, 2.0),
            (None, 1, 5, 5, 2.0),
            ("2025-01-03", None, 6, 5, 2.0),
            ("2025-01-03", 1, None, 5, 2.0),
            ("2025-01-03", 1, 7, None, 2.0),
            ("2025-01-03", 1, 8, -1, 2.0),
            ("2025-01-03", 1, 9, 5, -0.5),
            ("2025-01-03", 1, 10, 5, None),  # NULL is not >= 0
        ],
        SALES,
    )
    assert rows(clean_table("ventas", df)) == [(DAY, 1, 1, 5, 2.0), (DAY, 1, 2, 0, 0.0)]


def test_rules_on_absent_columns_do_not_apply(frame, rows):
    df = frame([("2025-01-03", 1, 1, 5)], SALES.rsplit(",", 1)[0])
    assert rows(clean_table("ventas", df)) == [(DAY, 1, 1, 5)]


def test_discount_is_filled_before_its_range_is_checked(frame, rows):
    values = [None, -5, 0, 100, 101]
    df = frame([("2025-01-03", 1, i, 1, d) for i, d in enumerate(values)], PROMOTIONS)
    kept = [(r[2], r[4]) for r in rows(clean_table("promociones", df))]
    assert kept == [(0, 0), (2, 0), (3, 100)]


def test_filling_happens_after_duplicates_are_dropped(frame):
    df = frame([("2025-01-03", 1, 1, 1, None), ("2025-01-03", 1, 1, 1, 0)], PROMOTIONS)
    assert clean_table("promociones", df).count() == 2


def test_weather(frame, rows):
    df = frame(
        [("2025-01-03", None, None), ("2025-01-04", 7.5, -1.0), ("2025-01-05", 8.0, float("nan"))],
        "fecha string, temperatura_media double, lluvia_mm double",
    )
    cleaned = rows(clean_table("clima", df))
    # a missing temperature stays, negative rain goes, NaN rain is no NULL and stays
    assert cleaned[0] == (DAY, None, 0.0)
    assert len(cleaned) == 2 and cleaned[1][2] != cleaned[1][2]


def test_products(frame, rows):
    df = frame(
        [(1, None, None), (2, "Pan", "Panaderia"), (None, "x", "y")],
        "id_producto int, nombre_producto string, categoria string",
    )
    assert rows(clean_table("productos", df)) == [
        (1, "Desconocido", "Sin categoria"),
        (2, "Pan", "Panaderia"),
    ]


def test_cleaning_twice_changes_nothing(frame, rows):
    df = frame(
        [("2025-01-03", 1, 1, 1, None), ("2025-01-04", 1, 1, 1, 7), ("x", 1, 1, 1, 7)], PROMOTIONS
    )
    once = clean_table("promociones", df)
    assert rows(clean_table("promociones", once)) == rows(once)


def test_filters_reach_the_scan(spark, tmp_path, frame):
    path = str(tmp_path / "v")
    frame([("2025-01-03", 1, 1, 5, 2.0)], SALES).selectExpr(
        "to_date(fecha) fecha", "id_tienda", "id_producto", "unidades_vendidas", "precio_unitario"
    ).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = clean_table("ventas", spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(unidades_vendidas,0)" in plan
    assert "GreaterThanOrEqual(precio_unitario,0.0)" in plan


def test_nulls_count_as_equal_among_identical_rows(frame):
    df = frame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert drop_identical_rows(df).count() == 2


def test_first_per_key(frame, rows):
    df = frame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "q")], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 3, "a"), (2, None, "q")]
    assert rows(repeated_keys(df, ["k"])) == [(1, 3)]


def test_appends(frame, rows):
    old = frame([(1, "old"), (2, "old")], "k int, v string")
    new = frame([("new", 2), ("new", 3), ("new", 3)], "v string, k int")
    assert append_rows(old, new).count() == 5
    assert rows(append_unique(old, new, ["k"])) == [(1, "old"), (2, "old"), (3, "new")]
