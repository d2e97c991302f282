"""Append-only audit tables: datasets, predictions, metrics.

Every table has a log of commits (``sinks/commits.py``) whose parts are runs: an append shows as
a whole or not at all, and writers do not undo each other. Writing a run again replaces that run
and nothing else, so a job that is repeated after a failure leaves no rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.functions.dates import date_from_parts
from shelfcast.functions.ids import row_id, with_serial
from shelfcast.operators.summaries import latest
from shelfcast.schemas import AUDIT_DATASET, AUDIT_METRICS, AUDIT_PREDICTIONS, SALE_KEYS
from shelfcast.sinks.commits import TARGET_BYTES, CommitLog, Snapshot, files_of_newest
from shelfcast.sources.staging import stage

TABLES: dict[str, StructType] = {
    "dataset_modelo": AUDIT_DATASET,
    "predicciones": AUDIT_PREDICTIONS,
    "metricas_modelo": AUDIT_METRICS,
}
# The column that tells when a row was made, where a table has one.
TIMES = {"predicciones": "fecha_prediccion", "metricas_modelo": "fecha_entrenamiento"}
RUN = "run_id"
DEFAULT_ALGORITHM = "RandomForestRegressor"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def audit_log(spark: SparkSession, root: str, table: str) -> CommitLog:
    return CommitLog(spark, table_path(root, table))


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the audit tables that do not exist yet; existing ones are left as they are."""
    for table in TABLES:
        audit_log(spark, root, table).commit(lambda now: {} if now.version < 0 else None)


def read_audit(
    spark: SparkSession, root: str, table: str, *, version: int | None = None
) -> DataFrame:
    """The table as of its newest commit, or of commit ``version``. What is appended later does
    not show in the result."""
    log = audit_log(spark, root, table)
    return log.read(TABLES[table], RUN, log.snapshot(version).files.values())


def read_latest(spark: SparkSession, root: str, table: str, n: int) -> DataFrame:
    """The ``n`` newest rows, from the files that can hold any of them."""
    log = audit_log(spark, root, table)
    files = files_of_newest(log.snapshot(), n)
    return latest(log.read(TABLES[table], RUN, files), TIMES[table], n)


def compact_audit(
    spark: SparkSession, root: str, table: str, *, target_bytes: int = TARGET_BYTES
) -> Snapshot:
    """Rows of many small runs, such as those of a stream, into few files."""
    log = audit_log(spark, root, table)
    return log.compact(TABLES[table], RUN, TIMES.get(table), target_bytes=target_bytes)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of an audit table, in its order and types."""
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def append_run(
    df: DataFrame, root: str, table: str, run_id: str, *, again: bool = True
) -> Snapshot:
    """Commit the rows of a run. One that is there already is replaced, or left as it is
    without ``again``: then nothing is even computed."""
    log = audit_log(df.sparkSession, root, table)
    if not again and run_id in log.snapshot().parts:
        return log.snapshot()
    files = log.write(conform(df, TABLES[table]), RUN, TIMES.get(table))
    return log.replace_parts([run_id], files, again=again)


def append_jdbc(df: DataFrame, table: str, options: dict[str, str]) -> None:
    """The same rows into a database table, through a JDBC driver on the class path."""
    rows = conform(df, TABLES[table])
    rows.write.mode("append").format("jdbc").options(dbtable=table, **options).save()


def dataset_rows(dataset: DataFrame, run_id: str) -> DataFrame:
    """Rows may be equal in every column (a promotion that occurs twice doubles its sales), so
    their ids are drawn. The draw has a seed per partition: a repeated task draws the same."""
    return dataset.withColumns({"run_id": F.lit(run_id), "id": F.uuid()})


def prediction_rows(predicted: DataFrame, run_id: str) -> DataFrame:
    """Equal requests are separate predictions, so their ids are drawn, not derived."""
    return predicted.withColumns(
        {
            "id": F.uuid(),
            "run_id": F.lit(run_id),
            "fecha_prediccion": F.current_timestamp(),
            "fecha_objetivo": date_from_parts(F.col("anio"), F.col("mes"), F.col("dia")),
            "prediccion_unidades": F.col("prediction").cast("double"),
        }
    )


def metric_rows(metrics: DataFrame, run_id: str, algorithm: str) -> DataFrame:
    return metrics.withColumns(
        {
            "id": row_id(run_id, "mae", "rmse", "r2"),
            "run_id": F.lit(run_id),
            "fecha_entrenamiento": F.current_timestamp(),
            "algoritmo": F.lit(algorithm),
        }
    )


def append_dataset(
    dataset: DataFrame, root: str, *, run_id: str, serial: bool = False
) -> Snapshot:
    """Append a dataset. With ``serial`` its ids are numbers that go on after the largest one of
    the table, without gaps; a run that is repeated with as many rows keeps its numbers."""
    if not serial:
        return append_run(dataset_rows(dataset, run_id), root, "dataset_modelo", run_id)
    rows = stage(dataset, "dataset-serial")
    first = audit_log(dataset.sparkSession, root, "dataset_modelo").reserve(run_id, rows.count())
    numbered = with_serial(rows, SALE_KEYS, first=first).withColumn(RUN, F.lit(run_id))
    return append_run(numbered, root, "dataset_modelo", run_id)


def append_predictions(
    predicted: DataFrame, root: str, *, run_id: str, again: bool = True
) -> Snapshot:
    return append_run(prediction_rows(predicted, run_id), root, "predicciones", run_id, again=again)


def append_metrics(
    metrics: DataFrame, root: str, *, run_id: str, algorithm: str = DEFAULT_ALGORITHM
) -> Snapshot:
    return append_run(metric_rows(metrics, run_id, algorithm), root, "metricas_modelo", run_id)
