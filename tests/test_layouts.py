import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.dedup import drop_identical_rows, drop_identical_wide_rows
from shelfcast.operators.joins import attach_promotions
from shelfcast.operators.lags import add_row_lags
from shelfcast.operators.metrics import (
    error_states,
    forecast_metrics,
    merge_error_states,
    metrics_of_states,
)
from shelfcast.operators.quantiles import merge_sketches, quantile_sketches, sketched_quantile
from shelfcast.schemas import RAW_SCHEMAS
from shelfcast.sinks.buckets import bucketed_history, joins_within_buckets, write_bucketed
from shelfcast.sources.tables import malformed_lines, read_table, unreadable_values

SALES = "fecha date, id_tienda int, id_producto int, unidades_vendidas double, precio_unitario double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark, n=4_000):
    return spark.range(n).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS fecha",
        "CAST(id % 5 AS INT) AS id_tienda",
        "CAST(id % 7 AS INT) AS id_producto",
        "CAST(id % 31 AS DOUBLE) AS unidades_vendidas",
        "1.5D AS precio_unitario",
    ).dropDuplicates(["fecha", "id_tienda", "id_producto"])


def test_buckets_need_no_exchange(spark, tmp_path, rows):
    df = sales(spark)
    promotions = df.where("id_producto < 3").selectExpr(
        "fecha", "id_tienda", "id_producto", "1 AS promocion_activa", "5.0D AS descuento_pct"
    )
    a = write_bucketed(df, "ventas_cubos", str(tmp_path / "v"), buckets=6)
    b = write_bucketed(promotions, "promociones_cubos", str(tmp_path / "p"), buckets=6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joins_within_buckets(spark):
            kept = bucketed_history(a, b)
            assert "Exchange" not in plan(kept) and "SortMergeJoin" in plan(kept)
            counted = a.groupBy("id_tienda", "id_producto").count()
            assert "Exchange" not in plan(counted)
            got = rows(kept)
        shuffled = add_row_lags(attach_promotions(df, promotions))
        assert plan(shuffled).count("Exchange") >= 2
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(shuffled) and len(got) > 600


def pairs(spark, n, offset):
    rng = random.Random(n)
    data = [(i % 7, offset + rng.gauss(0, 3), offset + rng.gauss(0, 3)) for i in range(n)]
    data += [(0, None, 1.0), (1, 1.0, None), (8, None, None)]
    return spark.createDataFrame(data, "g int, unidades_vendidas double, prediction double")


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_states_give_the_metrics_of_all_rows(spark, offset):
    df = pairs(spark, 3_000, offset)
    states = error_states(df, "g")
    merged = merge_error_states(states).first()
    y = F.col("unidades_vendidas")
    e = y - F.col("prediction")
    whole = (
        df.dropna()
        .withColumn("y0", y - offset)
        .agg(
            F.count("*").alias("n"), F.sum(e).alias("suma_error"), F.sum(F.abs(e)).alias("suma_abs"),
            F.sum(e * e).alias("suma_cuadrados"), F.avg("y0").alias("media"),
            (F.var_pop("y0") * F.count("*")).alias("m2"),
        )
        .first()
    )
    for name in ("n", "suma_error", "suma_abs", "suma_cuadrados", "m2"):
        assert abs(merged[name] - whole[name]) <= 1e-9 * max(1.0, abs(whole[name]))
    assert abs(merged["media"] - offset - whole["media"]) < 1e-6
    # in any order of merging
    halves = merge_error_states(states.withColumn("h", F.col("g") % 2), "h")
    again = merge_error_states(halves).first()
    assert all(abs(again[c] - merged[c]) <= 1e-9 * max(1.0, abs(merged[c])) for c in merged.asDict())
    measured = metrics_of_states(merge_error_states(states)).first()
    if not offset:
        assert measured == forecast_metrics(df.dropna()).first()


def test_states_without_rows(spark):
    df = pairs(spark, 0, 0.0)
    assert metrics_of_states(error_states(df, "g")).count() == 0
    one = merge_error_states(error_states(df)).collect()
    assert [tuple(r) for r in metrics_of_states(error_states(df)).collect()] == [(None, None, None)]
    assert one == [] or one[0].n is None


def test_merged_sketches_keep_the_bound(spark):
    df = spark.range(60_000).selectExpr(
        "id % 12 AS mes", "pow(id % 6007, 2) * (1 + (id % 12)) AS x"
    ).unionByName(spark.sql("SELECT 3L AS mes, CAST('NaN' AS DOUBLE) AS x UNION ALL SELECT 3L, NULL"))
    months = quantile_sketches(df, "x", "mes")
    merged = merge_sketches(months)
    assert merged.first().n == 60_000
    clean = df.where("x IS NOT NULL AND NOT isnan(x)")
    for q in (0.1, 0.5, 0.9):
        value = sketched_quantile(merged, "x", q).first().x
        ranks = clean.agg(
            F.avg((F.col("x") < value).cast("int")), F.avg((F.col("x") <= value).cast("int"))
        ).first()
        assert ranks[0] <= q + 0.01 and ranks[1] >= q - 0.01
    assert sketched_quantile(quantile_sketches(df.limit(0), "x", "mes"), "x").count() == 0


def shuffled_bytes(spark, df, folder):
    """Bytes of the shuffles of a run, from its plan's metrics."""
    df.write.mode("overwrite").parquet(folder)
    df._jdf.queryExecution()
    executed = df.select("*")
    executed.collect()
    total, todo = 0, [executed._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_unique_wide_rows_are_not_shuffled(spark, tmp_path, rows):
    wide = spark.range(3_000).select(
        (F.col("id") % 2_900).alias("id"), *[F.sha2(F.concat((F.col("id") % 2_900).cast("string"), F.lit(str(i))), 512).alias(f"c{i}") for i in range(20)]
    )
    wide.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    narrow, whole = drop_identical_wide_rows(stored), drop_identical_rows(stored)
    assert narrow.count() == 2_900 and rows(narrow) == rows(whole)
    assert shuffled_bytes(spark, narrow, str(tmp_path / "a")) * 3 < shuffled_bytes(spark, whole, str(tmp_path / "b"))
    assert rows(drop_identical_wide_rows(stored, limit=0)) == rows(whole)


def test_wide_rows_with_nulls_and_moved_values(frame, rows):
    # equal but for the place of the value: digests that skip nulls agree
    df = frame([(1, None), (None, 1), (None, None), (None, None), (1, None)], "a int, b int")
    assert rows(drop_identical_wide_rows(df)) == rows(df.dropDuplicates())
    assert drop_identical_wide_rows(df.limit(0)).count() == 0


LINES = """fecha,id_tienda,id_producto,unidades_vendidas,precio_unitario
2024-01-01,1,1,5,1.5
2024-01-02,1,1,5,1.5,7,8
2024-01-03,1
2024-01-04,1,1,"5,1.5
2024-01-05,1,1,5,"1.5

"2024-01-06",1,1,"6",1.5
2024-01-07,1,1,x,1.5
2024-01-08,1,1,,
"""


def test_malformed_lines_go_to_the_quarantine(spark, tmp_path):
    path = tmp_path / "ventas.csv"
    path.write_text(LINES)
    schema = RAW_SCHEMAS["ventas"]
    good = read_table(spark, str(path), schema=schema, bad="null").collect()
    assert sorted(r.fecha[-2:] for r in good) == ["01", "06", "07", "08"]
    bad = malformed_lines(spark, str(path)).collect()
    assert sorted((r.linea[8:10], r.motivo) for r in bad) == [
        ("02", "campos"), ("03", "campos"), ("04", "comillas"), ("05", "comillas")
    ]
    assert all(r.archivo.endswith("ventas.csv") for r in bad)
    assert unreadable_values(spark, str(path), schema).first().unidades_vendidas == 1
    for line in LINES.splitlines()[2:6]:
        path.write_text("\n".join([LINES.splitlines()[0], line]))
        with pytest.raises(Exception, match="malformed line"):
            read_table(spark, str(path), schema=schema).collect()


def test_lines_of_several_files_with_headers(spark, tmp_path):
    head, *lines = LINES.splitlines()
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("\n".join([head, *lines]))
    assert read_table(spark, str(tmp_path), schema=RAW_SCHEMAS["ventas"], bad="null").count() == 12
    assert malformed_lines(spark, str(tmp_path)).count() == 12
