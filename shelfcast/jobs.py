"""The pipeline as jobs for spark-submit: clean, features, refresh, train, audit, score, stream,
compact, reports.

    spark-submit --py-files shelfcast.zip shelfcast/jobs.py clean --raw DIR --out DIR

The session takes its master and settings from the submission.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfcast.operators.cleaning import clean_tables
from shelfcast.operators.requests import check_requests, rejected_requests, valid_requests
from shelfcast.operators.summaries import newest_first
from shelfcast.plans.dataset import model_dataset
from shelfcast.plans.incremental import SalesStore, refresh_dataset
from shelfcast.plans.scoring import predict
from shelfcast.plans.sizing import sized_shuffles
from shelfcast.plans.training import TREES, load_model, train_job
from shelfcast.schemas import RAW_REQUEST_SCHEMA, RAW_SCHEMAS, SALE_KEYS
from shelfcast.sinks.audit import (
    TABLES,
    append_dataset,
    append_predictions,
    compact_audit,
    create_tables,
    read_audit,
    read_latest,
)
from shelfcast.sinks.tables import write_dataset, write_table
from shelfcast.sources.staging import dropping_staged, staged
from shelfcast.sources.tables import (
    preview,
    read_clean_tables,
    read_model_dataset,
    read_raw_tables,
)
from shelfcast.streaming.requests import read_requests, score_stream, write_rejected


def clean_job(
    spark: SparkSession, raw: str, out: str, *, infer: bool = False, bad: str = "fail"
) -> None:
    """``raw``/<table>.csv to ``out``/<table>."""
    paths = {name: f"{raw}/{name}.csv" for name in RAW_SCHEMAS}
    tables = read_raw_tables(spark, paths, infer=infer, bad=bad)
    with sized_shuffles(spark, list(paths.values())):
        for name, df in clean_tables(tables).as_dict().items():
            write_table(df, f"{out}/{name}")


def features_job(
    spark: SparkSession, clean: str, out: str, *, calendar_lags: bool = False
) -> None:
    """Cleaned tables to the feature dataset, by year and month."""
    paths = {name: f"{clean}/{name}" for name in RAW_SCHEMAS}
    tables = read_clean_tables(spark, paths)
    with sized_shuffles(spark, list(paths.values())):
        dataset = model_dataset(tables, already_clean=True, calendar_lags=calendar_lags)
        write_dataset(dataset, out)


def refresh_job(spark: SparkSession, clean: str, store: str, out: str | None = None) -> None:
    """Cleaned tables of new days into the sales store; with ``out`` the whole dataset of the
    store, by year and month."""
    tables = read_clean_tables(spark, {name: f"{clean}/{name}" for name in RAW_SCHEMAS})
    refresh_dataset(spark, store, tables)
    if out is not None:
        write_dataset(SalesStore(spark, store).dataset(tables.clima, tables.productos), out)


def audit_job(spark: SparkSession, dataset: str, root: str, *, run_id: str) -> None:
    """Create the audit tables and append the dataset to its table."""
    create_tables(spark, root)
    append_dataset(read_model_dataset(spark, dataset), root, run_id=run_id)


def score_job(
    spark: SparkSession, requests: str, model: str, root: str, rejected: str, *, run_id: str
) -> None:
    """A batch of request files into the prediction audit table; invalid requests aside, under
    the name of the run."""
    read = check_requests(spark.read.schema(RAW_REQUEST_SCHEMA).json(requests))
    create_tables(spark, root)
    with staged(read, "requests") as checked:
        append_predictions(predict(load_model(model), valid_requests(checked)), root, run_id=run_id)
        write_rejected(rejected_requests(checked), rejected, run_id)


def stream_job(
    spark: SparkSession,
    requests: str,
    model: str,
    root: str,
    rejected: str,
    checkpoint: str,
    *,
    run_id: str,
) -> None:
    """Score the request files that have arrived since the last start into the prediction
    audit table; invalid requests aside."""
    create_tables(spark, root)
    checked = read_requests(spark, requests)
    stream = score_stream(checked, load_model(model), root, rejected, checkpoint, run_id=run_id)
    stream.awaitTermination()


def compact_job(spark: SparkSession, root: str) -> None:
    """Small files of the audit tables into few; earlier versions can still be read."""
    for table in TABLES:
        compact_audit(spark, root, table)


def reports_job(spark: SparkSession, root: str, out: str, *, rows: int = 10) -> None:
    """The reports over the audit tables: latest predictions, metrics by time, first rows of
    the dataset."""
    write_table(read_latest(spark, root, "predicciones", rows), f"{out}/predicciones")
    metrics = read_audit(spark, root, "metricas_modelo")
    write_table(newest_first(metrics, "fecha_entrenamiento"), f"{out}/metricas_modelo")
    dataset = read_audit(spark, root, "dataset_modelo")
    write_table(preview(dataset, [*SALE_KEYS, "id"], rows), f"{out}/dataset_modelo")


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shelfcast")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, run: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        if run:
            sub.add_argument("--run-id", dest="run_id", required=True)
        return sub

    clean = job("clean", "raw", "out")
    clean.add_argument("--infer", action="store_true")
    clean.add_argument("--bad", choices=["fail", "null"], default="fail")
    features = job("features", "clean", "out")
    features.add_argument("--calendar-lags", dest="calendar_lags", action="store_true")
    job("refresh", "clean", "store").add_argument("--out")
    job("compact", "root")
    train = job("train", "dataset-path", "model-path", "metrics-path", "audit-root", run=True)
    train.add_argument("--trees", type=int, default=TREES)
    job("audit", "dataset", "root", run=True)
    job("score", "requests", "model", "root", "rejected", run=True)
    job("stream", "requests", "model", "root", "rejected", "checkpoint", run=True)
    job("reports", "root", "out").add_argument("--rows", type=int, default=10)
    return parser


JOBS = {
    "clean": clean_job,
    "features": features_job,
    "refresh": refresh_job,
    "compact": compact_job,
    "train": train_job,
    "audit": audit_job,
    "score": score_job,
    "stream": stream_job,
    "reports": reports_job,
}


def main(argv: list[str] | None = None) -> None:
    options = vars(_arguments().parse_args(argv))
    spark = SparkSession.builder.appName("shelfcast").getOrCreate()
    with dropping_staged(spark):
        JOBS[options.pop("job")](spark, **options)


if __name__ == "__main__":
    main()
