"""Forecast error measures as aggregates over a table of actual and predicted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DECIMALS = 4


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def root_mean_squared_error(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2))))


def r_squared(actual: Column, predicted: Column) -> Column:
    """Share of the variance explained; NULL where the actual values do not vary."""
    error = F.avg(F.pow(actual - predicted, F.lit(2)))
    return 1 - error / F.nullif(F.var_pop(actual), F.lit(0.0))


def forecast_metrics(
    df: DataFrame, actual: str = "unidades_vendidas", predicted: str = "prediction"
) -> DataFrame:
    """One row with mae, rmse and r2, each to four decimals, from one pass."""
    pair = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.agg(
        F.round(mean_absolute_error(*pair), DECIMALS).alias("mae"),
        F.round(root_mean_squared_error(*pair), DECIMALS).alias("rmse"),
        F.round(r_squared(*pair), DECIMALS).alias("r2"),
    )


STATE_COLUMNS = ("n", "suma_error", "suma_abs", "suma_cuadrados", "media", "m2")


def error_states(
    df: DataFrame,
    *by: str,
    actual: str = "unidades_vendidas",
    predicted: str = "prediction",
) -> DataFrame:
    """Per value of ``by`` what the metrics of any union of its groups follow from: number of
    pairs, sums of the errors, their sizes and squares, mean of the actual values and the sum of
    their squared deviations from it. Rows without one of the two values do not count."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    rows = df.where(y.isNotNull() & p.isNotNull()).select(*by, y.alias("_y"), (y - p).alias("_e"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_e").alias("suma_error"),
        F.sum(F.abs("_e")).alias("suma_abs"),
        F.sum(F.col("_e") * F.col("_e")).alias("suma_cuadrados"),
        F.avg("_y").alias("media"),
        (F.var_pop("_y") * F.count("_y")).alias("m2"),
    )


def merge_error_states(states: DataFrame, *by: str) -> DataFrame:
    """The states of groups as those of their unions by ``by``. Means are added up as distances
    from one of them, so a large offset of the values costs no digits."""
    full = states.where("n > 0")
    # without ``by`` the window is over one row per group, not over the rows behind them
    near = F.min("media").over(Window.partitionBy(*by)).alias("_near")
    apart = F.col("media") - F.col("_near")
    sums = (
        full.select("*", near)
        .withColumn("_apart", apart)
        .groupBy(*by)
        .agg(
            F.sum("n").alias("n"),
            *[F.sum(c).alias(c) for c in ("suma_error", "suma_abs", "suma_cuadrados", "m2")],
            F.min("_near").alias("_near"),
            F.sum(F.col("n") * F.col("_apart")).alias("_first"),
            F.sum(F.col("n") * F.col("_apart") * F.col("_apart")).alias("_second"),
        )
    )
    moved = F.try_divide(F.col("_first"), F.col("n"))
    between = F.greatest(F.col("_second") - F.col("_first") * moved, F.lit(0.0))
    return sums.withColumns({"media": F.col("_near") + moved, "m2": F.col("m2") + between}).select(
        *by, *STATE_COLUMNS
    )


def metrics_of_states(states: DataFrame) -> DataFrame:
    """mae, rmse and r2 of each state, to four decimals, beside its other columns."""
    n = F.nullif(F.col("n"), F.lit(0))
    mean_square = F.col("suma_cuadrados") / n
    rest = [c for c in states.columns if c not in STATE_COLUMNS]
    return states.select(
        *rest,
        F.round(F.col("suma_abs") / n, DECIMALS).alias("mae"),
        F.round(F.sqrt(mean_square), DECIMALS).alias("rmse"),
        F.round(
            1 - F.col("suma_cuadrados") / F.nullif(F.col("m2"), F.lit(0.0)), DECIMALS
        ).alias("r2"),
    )
