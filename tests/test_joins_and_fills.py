import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog.fixtures import Fixtures
from shelfcast.operators.fills import fill_missing, fill_temperature
from shelfcast.operators.joins import (
    attach,
    attach_promotions,
    day_grid,
    lookup_base_price,
    lookup_category,
    lookup_discount,
    measure,
    merge_tables,
    products_without_price,
)
from shelfcast.operators.quantiles import approximate_quantile, discrete_quantile
from shelfcast.plans.dataset import model_dataset
from shelfcast.schemas import DATASET_COLUMNS
from shelfcast.sources.tables import RetailTables

DAY = datetime.date(2025, 1, 3)
NEXT = datetime.date(2025, 1, 4)


@pytest.fixture()
def tables(frame):
    return RetailTables(
        ventas=frame(
            [(DAY, 1, 1, 5.0, 2.0), (DAY, 1, 2, 6.0, 3.0), (NEXT, 2, 1, 7.0, 2.0)],
            "fecha date, id_tienda int, id_producto int, unidades_vendidas double,"
            "precio_unitario double",
        ),
        promociones=frame(
            [(DAY, 1, 1, 1, 10), (DAY, 1, 1, 1, 20), (NEXT, 2, 1, 1, None), (NEXT, 2, 1, 1, 20)],
            "fecha date, id_tienda int, id_producto int, promocion_activa int, descuento_pct int",
        ),
        clima=frame(
            [(DAY, 9.5, None)], "fecha date, temperatura_media double, lluvia_mm double"
        ),
        productos=frame(
            [(1, "Pan", "Panaderia")],
            "id_producto int, nombre_producto string, categoria string",
        ),
    )


def test_merge_keeps_sales_and_multiplies_repeated_keys(tables):
    merged = merge_tables(tables)
    assert merged.columns == list(DATASET_COLUMNS[:11])
    assert merged.count() == 5
    assert merged.where("id_producto = 2").first().nombre_producto is None


def test_fills(tables, rows):
    filled = fill_missing(merge_tables(tables)).select(
        "id_producto", "fecha", "promocion_activa", "descuento_pct", "temperatura_media", "lluvia_mm"
    )
    assert rows(filled) == [
        (1, DAY, 1, 10, 9.5, 0.0),
        (1, DAY, 1, 20, 9.5, 0.0),
        (1, NEXT, 1, 0, 9.5, 0.0),
        (1, NEXT, 1, 20, 9.5, 0.0),
        (2, DAY, 0, 0, 9.5, 0.0),
    ]
    assert dict(filled.dtypes)["descuento_pct"] == "int"


def test_without_any_temperature_the_gaps_stay(frame):
    df = frame([(None,), (None,)], "temperatura_media double")
    assert [r[0] for r in fill_temperature(df).collect()] == [None, None]


@pytest.mark.parametrize(
    ("values", "median"),
    [(range(1, 101), 50), (range(1, 5), 2), (range(1, 6), 3), ([7, None, 7, 7, 1], 7), ([], None)],
)
def test_median_takes_the_lower_middle(frame, values, median):
    df = frame([(None if v is None else float(v),) for v in values], "x double")
    assert discrete_quantile(df, "x").first()[0] == median


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_quantiles_of_any_spread(frame, q):
    rng = random.Random(q)
    draws = [
        lambda: rng.gauss(0, 1e-3),
        lambda: rng.gauss(0, 50),
        lambda: float(rng.randrange(5)),
        lambda: rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300),
    ]
    values = [rng.choice(draws)() for _ in range(2000)]
    df = frame([(v,) for v in [*values, float("nan")]], "x double")
    rank = max(1, -(-int(q * 1000) * len(values) // 1000))
    assert discrete_quantile(df, "x", q).first()[0] == sorted(values)[rank - 1]


def test_approximate_quantile_is_close(frame):
    df = frame([(float(i),) for i in range(5000)], "x double")
    assert abs(approximate_quantile(df, "x", 0.5, accuracy=1000).first()[0] - 2499) <= 10


def test_dimensions_are_measured(frame):
    unique = frame([(1, "a"), (2, "b")], "k int, v string")
    repeated = frame([(1, "a" * 1000), (1, "b")], "k int, v string")
    left = frame([(1,), (3,)], "k int")
    one, two = measure((unique, "k"), (repeated, "k"), limit=500)
    assert (one.unique, two.unique) == (True, False)
    plan = lambda d: attach(left, d)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan(one)
    assert "ResolvedHint" not in plan(two)
    assert attach(left, one, two).count() == 3


def test_lookups(tables, frame, rows):
    sales = tables.ventas.select("fecha", "id_tienda", "id_producto")
    discounts = lookup_discount(sales, tables.promociones).select("id_producto", "descuento_pct")
    assert rows(discounts) == [(1, 10), (1, 20), (2, 0)]  # NULL is no discount
    assert rows(lookup_category(sales, tables.productos).select("id_producto", "categoria")) == [
        (1, "Panaderia"),
        (1, "Panaderia"),
    ]
    prices = frame([(1, 1.5)], "id_producto int, precio_base double")
    assert rows(lookup_base_price(sales, prices).select("id_producto", "precio_base")) == [
        (1, 1.5),
        (1, 1.5),
        (2, None),
    ]
    assert rows(products_without_price(sales, prices)) == [(2,)]


def test_day_grid(tables):
    grid = day_grid(tables.productos, "2025-01-03", "2025-03-31", stores=3)
    assert grid.count() == 88 * 3
    assert grid.distinct().count() == 88 * 3


def test_promotion_join_leaves_the_strategy_open(tables):
    plan = attach_promotions(tables.ventas, tables.promociones)._jdf.queryExecution()
    assert "ResolvedHint" not in plan.analyzed().toString()


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize("repeat", [True, False])
def test_dataset_is_the_same_whichever_way_it_is_joined(spark, rows, staged, repeat):
    """Late joins, early joins after a repeated product, staged or not: same rows per product."""
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    t = fx.tables
    twice = t.productos.unionByName(
        t.productos.where("id_producto = 3").withColumn("categoria", F.lit("otra"))
    )
    got = model_dataset(
        RetailTables(t.ventas, t.promociones, t.clima, twice if repeat else t.productos),
        staged=staged,
    )
    assert got.columns == list(DATASET_COLUMNS)
    others = got.where("id_producto <> 3")
    plain = model_dataset(t).where("id_producto <> 3")
    # the median may move where rows are multiplied, so temperatures are left out
    assert rows(others.drop("temperatura_media")) == rows(plain.drop("temperatura_media"))
    if repeat:
        assert got.where("id_producto = 3").select("categoria").distinct().count() == 2
    else:
        assert rows(got) == rows(model_dataset(t))


def test_a_repeated_day_without_sales_changes_nothing(spark, rows):
    """Repeated sale keys, so that the lags are a matter of the order of ties."""
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    t = fx.tables
    far = t.clima.limit(1).withColumn("fecha", F.lit(datetime.date(2030, 1, 1)))
    plain, repeated = (
        model_dataset(RetailTables(fx["ventas_doble"], t.promociones, weather, t.productos))
        for weather in (t.clima.unionByName(far), t.clima.unionByName(far).unionByName(
            far.withColumn("lluvia_mm", F.lit(99.0))))
    )
    assert rows(plain) == rows(repeated)


def test_median_orders_ranges_not_the_table(frame):
    df = frame([(float(i % 997),) for i in range(5000)], "x double")
    plan = discrete_quantile(df, "x")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "value#" in line]
    assert windows and all("[range#" in line for line in windows)
