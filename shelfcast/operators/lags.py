"""Lag and rolling-mean features per store and product.

Row features look back over the previous rows of a group, calendar features over the
previous days. A group normally is one row per day and fits one task with ease. Where keys
repeat, a single group, or a single day of it, may hold a large share of the table; for row
features such groups are counted first and take a path on which no task sees more than a
bounded block, with the same result. Calendar features work on sums per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.schemas import GROUP_KEYS, LAG_COLUMNS, SALE_COLUMNS, TARGET
from shelfcast.sources.staging import stage

HISTORY = 7
HOT_GROUP_ROWS = 5_000_000
BLOCK_ROWS = 1_000_000


def lag(n: int, window: WindowSpec, target: str = TARGET) -> Column:
    return F.lag(target, n).over(window)


def rolling_mean(window: WindowSpec, rows: int = HISTORY, target: str = TARGET) -> Column:
    """Mean of the previous rows, the current one left out; short histories count too."""
    return F.avg(target).over(window.rowsBetween(-rows, -1))


def _row_features(window: WindowSpec) -> dict[str, Column]:
    return {
        "lag_1": lag(1, window),
        "lag_7": lag(HISTORY, window),
        "media_movil_7": rolling_mean(window),
    }


def hot_groups(df: DataFrame, max_rows: int) -> DataFrame:
    """Store-product pairs with more than ``max_rows`` rows: at most rows / max_rows of them."""
    return df.groupBy(*GROUP_KEYS).count().where(F.col("count") > max_rows).drop("count")


def _with_ties(df: DataFrame) -> DataFrame:
    """Order among rows of one day: any will do, but it has to be the same on every attempt and
    must not change with what has been joined to a sale. So the digest of the sale decides,
    and only among rows of one sale, which joins with repeated keys make, that of the row."""
    sale = [c for c in SALE_COLUMNS if c in df.columns]
    return df.withColumns({"_tie": F.xxhash64(*sale), "_tie2": F.xxhash64(*df.columns)})


def _lags_per_group(df: DataFrame) -> DataFrame:
    window = Window.partitionBy(*GROUP_KEYS).orderBy("fecha", "_tie", "_tie2")
    return _with_ties(df).withColumns(_row_features(window)).drop("_tie", "_tie2")


def _lags_per_block(df: DataFrame, block_rows: int) -> DataFrame:
    """The same features with a group cut into blocks: a day, or a slice of a crowded day.

    Every block gets the last rows before it as a prefix, so a window inside the block sees
    the history that a window over the whole group would see.
    """
    day = [*GROUP_KEYS, "fecha"]
    block = [*day, "_slice"]
    rows = _with_ties(df)

    crowded = (
        rows.groupBy(*day)
        .count()
        .where(F.col("count") > block_rows)
        .select(*day, F.ceil(F.col("count") / block_rows).alias("_slices"))
    )
    # the tie-break is a uniform hash, so cutting its range cuts the day evenly and in order
    position = F.col("_tie") / F.lit(2.0**64) + 0.5
    rows = (
        rows.join(crowded, day, "left")  # small as a rule, but left to the planner
        .withColumn("_slice", F.floor(position * F.coalesce("_slices", F.lit(1))))
        .drop("_slices")
    )

    latest = Window.partitionBy(*block).orderBy(F.desc("_tie"), F.desc("_tie2"))
    tails = (
        rows.select(*block, "_tie", "_tie2", TARGET)
        .withColumn("_age", F.row_number().over(latest))
        .where(F.col("_age") <= HISTORY)
        .groupBy(*block)
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("_age"), F.col(TARGET)))).alias("_tail"))
    )
    # blocks have at least one row each, so the seven before hold all the history there is
    before = Window.partitionBy(*GROUP_KEYS).orderBy("fecha", "_slice").rowsBetween(-HISTORY, -1)
    history = F.flatten(F.collect_list("_tail").over(before))
    prefixes = (
        tails.select(*block, history.alias("_history"))
        .select(
            *block,
            F.posexplode(
                F.slice(
                    "_history",
                    F.greatest(F.size("_history") - HISTORY + 1, F.lit(1)),
                    F.lit(HISTORY),
                )
            ).alias("_tie", "_row"),
        )
        .select(
            *block,
            F.col("_tie").cast("long"),
            F.lit(0).cast("long").alias("_tie2"),
            F.col(f"_row.{TARGET}").alias(TARGET),
            F.lit(False).alias("_own"),
        )
    )

    window = Window.partitionBy(*block).orderBy("_own", "_tie", "_tie2")
    return (
        rows.withColumn("_own", F.lit(True))
        .unionByName(prefixes, allowMissingColumns=True)
        .withColumns(_row_features(window))
        .where("_own")
        .select(*df.columns, *LAG_COLUMNS)
    )


def _split_hot(df: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and those of hot ones if there are any. The hot groups are
    found by a job of its own over ``df``, best a stored table; they are stored, so that the
    planner sees their size and the two joins do not search for them again."""
    hot = stage(hot_groups(df, max_rows), "hot-groups")
    if hot.isEmpty():
        return df, None
    return tuple(
        df.join(hot, list(GROUP_KEYS), how).select(*df.columns)
        for how in ("left_anti", "left_semi")
    )


def add_row_lags(
    df: DataFrame, hot_rows: int = HOT_GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """lag_1, lag_7 and media_movil_7 over the previous rows of the store and product."""
    ordinary, hot = _split_hot(df, hot_rows)
    result = _lags_per_group(ordinary)
    return result if hot is None else result.unionByName(_lags_per_block(hot, block_rows))


def _day_frame(start: int, end: int) -> WindowSpec:
    by_day = Window.partitionBy(*GROUP_KEYS).orderBy(F.unix_date("fecha"))
    return by_day.rangeBetween(start, end)


def _calendar_lags_by_day(df: DataFrame) -> DataFrame:
    """Rows of one day share one frame, so days are summed up first and joined back."""
    day = [*GROUP_KEYS, "fecha"]
    past = _day_frame(-HISTORY, -1)
    days = (
        df.groupBy(*day)
        .agg(
            F.max(TARGET).alias("_max"), F.sum(TARGET).alias("_sum"), F.count(TARGET).alias("_n")
        )
        .select(
            *day,
            F.max("_max").over(_day_frame(-1, -1)).alias("lag_1"),
            F.max("_max").over(_day_frame(-HISTORY, -HISTORY)).alias("lag_7"),
            F.try_divide(F.sum("_sum").over(past), F.sum("_n").over(past)).alias("media_movil_7"),
        )
    )
    return df.join(days, day, "left").select(*df.columns, *LAG_COLUMNS)


def add_calendar_lags(df: DataFrame) -> DataFrame:
    """The same columns by date: yesterday, seven days ago, mean of the last seven days.
    Days without a row are no history; of repeated keys the lags take the largest value.

    All groups take the one path: days are summed up before they are shuffled, so a group
    has as many rows as it has days, however many sales."""
    return _calendar_lags_by_day(df)


def drop_short_history(df: DataFrame) -> DataFrame:
    """Rows whose three history features all have a value (NaN is none)."""
    return df.dropna(subset=list(LAG_COLUMNS))
