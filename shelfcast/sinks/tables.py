"""Writing tables and the metrics file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """A directory of part files, written by the tasks that hold the rows."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def by_month(df: DataFrame) -> DataFrame:
    """Rows of a month in few partitions; adaptive execution splits a month that is far larger
    than others, which a plain repartition by month would leave to one task."""
    return df.hint("rebalance", F.col("anio"), F.col("mes"))


def write_dataset(df: DataFrame, path: str) -> None:
    """The feature dataset by year and month, so that readers of a period skip the rest."""
    by_month(df).write.mode("overwrite").partitionBy("anio", "mes").parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """One JSON object with the keys MAE, RMSE and R2."""
    named = metrics.select(
        F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"), F.col("r2").alias("R2")
    )
    named.coalesce(1).write.mode("overwrite").json(path)
