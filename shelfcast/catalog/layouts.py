"""Queries over kept tables: commit logs, increments, buckets, sketches and states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog.fixtures import Fixtures
from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import METRICS, row_history
from shelfcast.operators.cleaning import clean_tables
from shelfcast.operators.dedup import drop_identical_wide_rows
from shelfcast.operators.metrics import error_states, merge_error_states, metrics_of_states
from shelfcast.operators.quantiles import merge_sketches, quantile_sketches, sketched_quantile
from shelfcast.plans.dataset import model_dataset
from shelfcast.plans.incremental import SalesStore
from shelfcast.schemas import RAW_SCHEMAS
from shelfcast.sinks import audit
from shelfcast.sinks.buckets import bucketed_history, joins_within_buckets, write_bucketed
from shelfcast.sources.staging import new_path, stage
from shelfcast.sources.tables import malformed_lines, read_table


def _forecast(fx: Fixtures) -> DataFrame:
    """The dataset with the units of seven rows before as the forecast of each."""
    return stage(model_dataset(fx.tables).withColumn("prediction", F.col("lag_7")), "forecast")


def _quarters(fx: Fixtures) -> tuple[str, list[str]]:
    """An audit table with the forecasts of each quarter of a year as a run."""
    root = new_path(fx.spark, "audit")
    rows = _forecast(fx)
    runs = []
    for quarter in range(1, 5):
        runs.append(f"t{quarter}")
        part = rows.where(F.ceil(F.col("mes") / 3) == quarter)
        audit.append_predictions(part, root, run_id=runs[-1])
    return root, runs


def _per_run(df: DataFrame) -> DataFrame:
    return df.groupBy("run_id").agg(
        F.count("*").alias("filas"), F.sum("prediccion_unidades").alias("unidades")
    )


_QUARTER_SQL = """SELECT 't' || CAST(CAST(ceil(mes / 3.0) AS INT) AS VARCHAR) AS run_id,
  count(*) AS filas, sum(lag_7) AS unidades FROM {dataset} GROUP BY 1"""


@query(
    "audit_two_versions",
    f"""SELECT v AS version, run_id, filas, unidades FROM ({_QUARTER_SQL}),
  (VALUES (1), (3)) t(v) WHERE CAST(run_id[2:] AS INT) <= v + 1""",
)
def _(fx):
    """The prediction table as of its second and of its fourth commit."""
    root, _ = _quarters(fx)
    versions = [
        _per_run(audit.read_audit(fx.spark, root, "predicciones", version=v)).select(
            F.lit(v).alias("version"), "*"
        )
        for v in (1, 3)
    ]
    return reduce(DataFrame.unionByName, versions)


@query(
    "audit_compacted_runs",
    f"SELECT run_id, filas, unidades, TRUE AS un_archivo FROM ({_QUARTER_SQL})",
)
def _(fx):
    """Runs put into one file, one of them replaced by itself afterwards and compacted again."""
    root, runs = _quarters(fx)
    audit.compact_audit(fx.spark, root, "predicciones")
    again = _forecast(fx).where(F.ceil(F.col("mes") / 3) == 2)
    audit.append_predictions(again, root, run_id=runs[1])
    few = audit.compact_audit(fx.spark, root, "predicciones")
    rows = _per_run(audit.read_audit(fx.spark, root, "predicciones"))
    return rows.withColumn("un_archivo", F.lit(len(few.files) == 1))


@query(
    "audit_latest_from_few_files",
    "SELECT 't4' AS run_id, count(*) AS filas, TRUE AS menos_archivos FROM "
    "(SELECT * FROM {dataset} WHERE mes > 9 LIMIT 20)",
)
def _(fx):
    """The twenty newest predictions, all of the last run, without a look at the others."""
    root, _ = _quarters(fx)
    newest = audit.read_latest(fx.spark, root, "predicciones", 20)
    read = len(newest.inputFiles())
    every = len(audit.read_audit(fx.spark, root, "predicciones").inputFiles())
    return newest.groupBy("run_id").agg(F.count("*").alias("filas")).withColumn(
        "menos_archivos", F.lit(read < every)
    )


@query(
    "audit_dense_serial",
    """SELECT run_id, filas, CAST(sum(filas) OVER (ORDER BY run_id) - filas + 1 AS BIGINT) AS primero,
  CAST(sum(filas) OVER (ORDER BY run_id) AS BIGINT) AS ultimo, filas AS distintos FROM (
  SELECT CASE WHEN mes <= 6 THEN 'a' ELSE 'b' END AS run_id, count(*) AS filas FROM {dataset} GROUP BY 1)""",
)
def _(fx):
    """Two appends, the second repeated: ids go from 1 to the number of all rows."""
    root = new_path(fx.spark, "audit")
    dataset = stage(model_dataset(fx.tables), "dataset")
    for run, rows in (("a", "mes <= 6"), ("b", "mes > 6"), ("b", "mes > 6")):
        audit.append_dataset(dataset.where(rows), root, run_id=run, serial=True)
    number = F.col("id").cast("long")
    return (
        audit.read_audit(fx.spark, root, "dataset_modelo")
        .groupBy("run_id")
        .agg(
            F.count("*").alias("filas"),
            F.min(number).alias("primero"),
            F.max(number).alias("ultimo"),
            F.count_distinct(number).alias("distintos"),
        )
    )


@query("incremental_dataset", "SELECT * FROM {dataset}")
def _(fx):
    """The dataset from three refreshes of the store, the second with late sales, the third
    with sales that are there already."""
    tables = clean_tables(fx.tables)
    sales, promotions = stage(tables.ventas, "sales"), stage(tables.promociones, "promotions")
    store = SalesStore(fx.spark, new_path(fx.spark, "sales-store"))
    late = F.col("id_producto") % 7 == 3
    year = F.year("fecha")
    middle = sales.select(F.floor(F.avg(year))).first()[0]
    for part in (
        (year < middle) & ~late,
        (year == middle) | (year < middle) & late,
        (year > middle) | (year == middle) & late,
    ):
        store.refresh(sales.where(part), promotions)
    whole = store.dataset(tables.clima, tables.productos)
    # types as they come from the fixtures
    return whole.withColumn("descuento_pct", F.col("descuento_pct").cast("int"))


@query(
    "bucketed_history",
    row_history("(SELECT * FROM {ventas} LEFT JOIN {promociones} USING (fecha, id_tienda, id_producto))"),
)
def _(fx):
    """Promotions and row lags over bucketed tables: the plan moves no sales."""
    stored = {}
    for name in ("ventas", "promociones"):
        path = new_path(fx.spark, f"{name}-buckets")
        stored[name] = write_bucketed(fx[name], path.rsplit("/", 1)[1].replace("-", "_"), path, buckets=8)
    with joins_within_buckets(fx.spark):
        # planned and run here; what is read later needs no such plan
        return stage(bucketed_history(stored["ventas"], stored["promociones"]), "bucketed")


@query(
    "median_from_month_sketches",
    """SELECT anio, count(*) AS filas, TRUE AS dentro FROM (
  SELECT year(fecha) AS anio FROM {ventas}) GROUP BY anio""",
)
def _(fx):
    """Median prices of years from stored sketches of their months: within 1 % by rank."""
    sales = fx["ventas"].withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    months = stage(quantile_sketches(sales, "precio_unitario", "anio", "mes"), "month-sketches")
    medians = sketched_quantile(merge_sketches(months, "anio"), "precio_unitario")
    near = sales.join(medians.withColumnRenamed("precio_unitario", "mediana"), "anio")
    price, median = F.col("precio_unitario"), F.col("mediana")
    below, upto = F.avg((price < median).cast("int")), F.avg((price <= median).cast("int"))
    least = 1 / F.count(F.lit(1))  # years of few rows
    return near.groupBy("anio").agg(
        F.count("*").alias("filas"),
        ((below <= 0.51 + least) & (upto >= 0.49 - least)).alias("dentro"),
    )


@query(
    "metrics_from_month_states",
    f"""SELECT anio, {METRICS} FROM {{dataset}} GROUP BY anio
UNION ALL SELECT NULL AS anio, {METRICS} FROM {{dataset}}""",
)
def _(fx):
    """Errors of years and of all rows from stored states of the months."""
    rows = _forecast(fx)
    months = stage(error_states(rows, "anio", "mes"), "month-states")
    whole = metrics_of_states(merge_error_states(months)).withColumn("anio", F.lit(None).cast("int"))
    return metrics_of_states(merge_error_states(months, "anio")).unionByName(whole)


@query(
    "drop_identical_wide_rows",
    """SELECT * FROM {part} UNION ALL
SELECT * REPLACE (p_partkey + 1000000000 AS p_partkey) FROM {part}""",
)
def _(fx):
    """All parts twice under two keys, a seventh of them once more."""
    part = fx.spark.read.parquet(f"{fx.sf_dir}/part.parquet")
    moved = part.withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000)
    again = part.where("p_partkey % 7 = 0")
    return drop_identical_wide_rows(stage(part.unionByName(moved).unionByName(again), "wide"))


def _soiled_lines(fx: Fixtures) -> str:
    """Sales as CSV lines in files of their own, by product: with a field too many, with two too
    few, with a quote left open, or as they should be."""
    kind = F.col("id_producto") % 5
    names = [f.name for f in RAW_SCHEMAS["ventas"].fields]
    fields = [F.col(c).cast("string") for c in names]
    line = (
        F.when(kind == 1, F.concat_ws(",", *fields, F.lit("x")))
        .when(kind == 2, F.concat_ws(",", *fields[:3]))
        .when(kind == 3, F.concat(F.concat_ws(",", *fields[:4]), F.lit(',"'), fields[4]))
        .otherwise(F.concat_ws(",", *fields))
    )
    rows = fx["ventas"].select(
        F.pmod(F.xxhash64(*names), F.lit(4)).alias("k"), F.lit(1).alias("n"), line.alias("linea")
    )
    # every file begins with the header
    heads = fx.spark.range(4).select(
        F.col("id").alias("k"), F.lit(0).alias("n"), F.lit(",".join(names)).alias("linea")
    )
    path = new_path(fx.spark, "soiled-csv")
    lines = heads.unionByName(rows).repartition(4, "k").sortWithinPartitions("n")
    lines.select("linea").write.text(path)
    return path


@query(
    "csv_malformed_lines",
    """SELECT CAST(fecha AS VARCHAR) AS fecha, id_tienda, id_producto, unidades_vendidas,
       precio_unitario, NULL AS motivo, CAST(1 AS BIGINT) AS lineas
FROM {ventas} WHERE id_producto % 5 IN (0, 4)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, CASE WHEN id_producto % 5 = 3 THEN 'comillas' ELSE 'campos' END,
       count(*) FROM {ventas} WHERE id_producto % 5 IN (1, 2, 3) GROUP BY 6""",
)
def _(fx):
    """The good lines of a CSV as sales, and how many are in the quarantine for what."""
    path = _soiled_lines(fx)
    good = read_table(fx.spark, path, schema=RAW_SCHEMAS["ventas"], bad="null")
    bad = malformed_lines(fx.spark, path).groupBy("motivo").agg(F.count("*").alias("lineas"))
    return good.withColumn("lineas", F.lit(1).cast("long")).unionByName(bad, allowMissingColumns=True)
