"""Scoring request files as they arrive.

The stream is stateless. Each micro-batch is read and checked once and then split: valid
requests are scored and committed to the prediction audit table as a run of their own,
rejected ones go to the quarantine by batch. A batch that an earlier attempt has committed is
not scored again, its quarantine is replaced, and the checkpoint remembers which files were
read, so a restart neither repeats nor loses a request. Rows of other runs stay as they are.
Every ``COMPACT_EVERY`` batches the small files of the table become few.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.requests import check_requests, rejected_requests, valid_requests
from shelfcast.plans.scoring import predict
from shelfcast.schemas import RAW_REQUEST_SCHEMA
from shelfcast.sinks.audit import append_predictions, compact_audit
from shelfcast.sources.staging import staged

FILES_PER_BATCH = 1000
COMPACT_EVERY = 50
BATCH = "lote"


def read_requests(
    spark: SparkSession, path: str, *, fmt: str = "json", max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """Request files as a stream of checked requests; a backlog is read in bounded batches."""
    reader = spark.readStream.schema(RAW_REQUEST_SCHEMA).format(fmt)
    return check_requests(reader.option("maxFilesPerTrigger", max_files).load(path))


def write_rejected(rejected: DataFrame, path: str, batch: str) -> None:
    """Rejected requests with the names of their invalid fields, under the name of the batch."""
    (
        rejected.withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def _each_batch(
    model: PipelineModel, audit_root: str, rejected_path: str, run_id: str
) -> Callable[[DataFrame, int], None]:
    def process(checked: DataFrame, batch: int) -> None:
        run = f"{run_id}-{batch}"
        with staged(checked, "request-batch") as stored:  # the requests are read once
            predicted = predict(model, valid_requests(stored))
            append_predictions(predicted, audit_root, run_id=run, again=False)
            write_rejected(rejected_requests(stored), rejected_path, run)
        if batch % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact_audit(checked.sparkSession, audit_root, "predicciones")

    return process


def score_stream(
    checked: DataFrame,
    model: PipelineModel,
    audit_root: str,
    rejected_path: str,
    checkpoint: str,
    *,
    run_id: str,
) -> StreamingQuery:
    """Predictions of the valid requests into the audit table of ``audit_root`` as the runs
    ``run_id``-0, -1, ...; rejected requests to ``rejected_path``."""
    return (
        checked.writeStream.foreachBatch(_each_batch(model, audit_root, rejected_path, run_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
