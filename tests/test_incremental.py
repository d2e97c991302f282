import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.dataset import model_dataset
from shelfcast.plans.incremental import SalesStore
from shelfcast.schemas import CLEAN_SCHEMAS
from shelfcast.sources.tables import RetailTables

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """Three stores, four products, 130 days; a few sales repeat their key or are missing."""
    rng = random.Random(1)
    sales, promotions = [], []
    for day in range(130):
        for store in range(3):
            for product in range(4):
                if rng.random() < 0.25:
                    continue
                key = (START + timedelta(day), store, product)
                sales.append((*key, float(rng.randrange(50)), 1.0 + product))
                if rng.random() < 0.05:
                    sales.append((*key, float(rng.randrange(50)), 9.0))
                if rng.random() < 0.3:
                    promotions.append((*key, 1, float(rng.randrange(40))))
    weather = [(START + timedelta(d), float(d % 30), 0.0) for d in range(130) if d % 9]
    products = [(p, f"p{p}", "c") for p in range(3)]
    made = {"ventas": sales, "promociones": promotions, "clima": weather, "productos": products}
    return RetailTables(**{n: spark.createDataFrame(r, CLEAN_SCHEMAS[n]) for n, r in made.items()})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_of(store, month):
    part = f"ventas-{month}"
    return {f.path for f in store.log.snapshot().files.values() if part in f.shares}


def test_three_increments_equal_the_whole_build(spark, tables, tmp_path):
    """The second increment brings late sales of February, the third the rest and sales that are
    there already."""
    store = SalesStore(spark, str(tmp_path / "store"))
    day = F.col("fecha")
    late = (F.xxhash64("fecha", "id_tienda", "id_producto") % 11 == 0) & (F.month("fecha") == 2)
    parts = [
        (day < "2024-03-20") & ~late,
        (day >= "2024-03-20") & (day < "2024-04-10") | late,
        day >= "2024-04-01",
    ]
    store.refresh(tables.ventas.where(parts[0]), tables.promociones.where(day < "2024-03-20"))
    january = files_of(store, "2024-01")
    assert january
    store.refresh(tables.ventas.where(parts[1]), tables.promociones)
    assert files_of(store, "2024-01") == january  # untouched
    february = files_of(store, "2024-02")
    store.refresh(tables.ventas.where(parts[2]), tables.promociones)
    assert files_of(store, "2024-01") == january and files_of(store, "2024-02") == february
    whole = model_dataset(tables, already_clean=True)
    kept = store.dataset(tables.clima, tables.productos)
    assert rows_of(kept) == rows_of(whole) and kept.count() > 900
    # nothing new: no commit
    version = store.log.snapshot().version
    store.refresh(tables.ventas.where(F.month("fecha") == 2), tables.promociones)
    assert store.log.snapshot().version == version
    # a reader of an earlier version still sees it
    assert store.sales(0).count() == tables.ventas.where(parts[0]).dropDuplicates().count()


def test_late_sales_of_one_pair_change_the_seven_rows_behind_them(spark, tmp_path, frame):
    def sales(days):
        return frame(
            [(START + timedelta(d), 1, 1, float(d), 2.0) for d in days],
            "fecha date, id_tienda int, id_producto int, unidades_vendidas double, precio_unitario double",
        )

    none = spark.createDataFrame([], CLEAN_SCHEMAS["promociones"])
    store = SalesStore(spark, str(tmp_path / "store"))
    every = [*range(0, 90, 3)]
    store.refresh(sales([d for d in every if d not in (30, 33)]), none)
    march = files_of(store, "2024-03")
    store.refresh(sales([30, 33]), none)
    other = SalesStore(spark, str(tmp_path / "other"))
    other.refresh(sales(every), none)
    assert rows_of(store.sales()) == rows_of(other.sales())
    # day 33 is 3 February; the seventh row behind it is of 24 February
    assert files_of(store, "2024-03") == march
    tails = [s._read("colas", ["2024-02", "2024-03"], s.log.snapshot()) for s in (store, other)]
    assert rows_of(tails[0]) == rows_of(tails[1]) and tails[0].count() == 14


def test_months_without_sales_and_new_groups(spark, tmp_path, frame):
    schema = "fecha date, id_tienda int, id_producto int, unidades_vendidas double, precio_unitario double"
    rows = [(date(2023, 1 + m, 1 + d), 1, 1, float(m + d), 1.0) for m in (0, 1, 7) for d in range(4)]
    rows += [(date(2023, 8, 1 + d), 2, 1, float(d), 1.0) for d in range(9)]
    none = spark.createDataFrame([], CLEAN_SCHEMAS["promociones"])
    store, whole = (SalesStore(spark, str(tmp_path / n)) for n in "ab")
    for part in (rows[:6], rows[6:10], rows[10:]):
        store.refresh(frame(part, schema), none)
    whole.refresh(frame(rows, schema), none)
    assert rows_of(store.sales()) == rows_of(whole.sales())
    assert store.refresh(frame([], schema), none).version == 2
    assert SalesStore(spark, str(tmp_path / "c")).sales().count() == 0


def test_dimensions_must_have_one_row_per_key(spark, tables, tmp_path):
    store = SalesStore(spark, str(tmp_path / "store"))
    twice = tables.productos.unionByName(tables.productos)
    with pytest.raises(ValueError):
        store.dataset(tables.clima, twice)
