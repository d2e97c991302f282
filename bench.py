"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from shelfcast.catalog import QUERIES  # noqa: E402
from shelfcast.catalog.fixtures import Fixtures  # noqa: E402
from shelfcast.plans.dataset import model_dataset  # noqa: E402
from shelfcast.plans.training import TREES, evaluate, split_by_key, train_forest  # noqa: E402
from shelfcast.sources.staging import stage  # noqa: E402

HEADLINE = (
    "clean_sales",
    "clean_promotions",
    "join_promotions",
    "merge_tables",
    "fill_missing",
    "row_lags",
    "row_lags_in_blocks",
    "calendar_lags",
    "model_dataset",
    "model_dataset_calendar_lags",
    "median_price",
    "forecast_metrics",
    "units_by_store",
    "valid_requests",
    "split_by_time",
    "load_model_dataset",
)
# The forest as it is trained (TREES), over the rows of the bench and over the smaller
# directory beside it that the baseline was measured on.
SMALL = "sf0.01"


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def forest_seconds(spark: SparkSession, sf_dir: str, name: str) -> dict[str, float]:
    """Fit and evaluation, each over the stored dataset of ``sf_dir``."""
    dataset = stage(model_dataset(Fixtures(spark, sf_dir).tables), name)
    train, test = split_by_key(dataset)
    models = []
    fit = timed(lambda: models.append(train_forest(train)))
    return {
        f"{name}_fit": fit,
        f"{name}_evaluation": timed(lambda: evaluate(models[0], test).collect()),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(Fixtures(spark, sf_dir)["ventas"])  # warm-up

    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, sf_dir))) for name in HEADLINE}
    seconds |= forest_seconds(spark, sf_dir, f"forest_{TREES}_trees")
    small = str(Path(sf_dir).parent / SMALL)
    if Path(sf_dir).name != SMALL and Path(small).exists():
        seconds |= forest_seconds(spark, small, f"forest_{TREES}_trees_{SMALL}")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
