"""The sales history kept up to date as days arrive, without a rebuild.

The store holds, per month, the sales with their promotions and row lags, and for the end of
each month the last seven sales of every store and product. A refresh reads the state before
the earliest month it touches and the months from there on, recomputes the history of the stores
and products it brings rows for, and commits the months that change and the states behind them in
one commit (``sinks/commits.py``): a reader sees the store before or after, files of other months
are not touched. Late sales are rows like any others: the seven rows behind them get new lags.

What depends on the whole table (weather, products, the fills by median, calendar columns) is
attached on reading, as ``model_dataset`` does it. So the dataset read from the store equals the
one built at once from all rows.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfcast.functions.calendar import add_calendar
from shelfcast.operators.fills import fill_missing
from shelfcast.operators.joins import attach, attach_promotions, measure
from shelfcast.operators.lags import HISTORY, add_row_lags, drop_short_history
from shelfcast.schemas import (
    CLEAN_SCHEMAS,
    DATASET_COLUMNS,
    GROUP_KEYS,
    LAG_COLUMNS,
    SALE_COLUMNS,
    TARGET,
)
from shelfcast.sinks.commits import CommitLog, DataFile, Snapshot
from shelfcast.sources.staging import stage
from shelfcast.sources.tables import RetailTables

SALES, TAILS = "ventas", "colas"
PART = "parte"


def _month(day: str = "fecha") -> Column:
    return F.date_format(day, "yyyy-MM")


def _part(table: str, month: Column) -> Column:
    return F.concat(F.lit(f"{table}-"), month)


def _schemas(sales: StructType) -> dict[str, StructType]:
    """Stored columns: sales with their lags; tails with the order of their rows."""
    part = StructField(PART, StringType())
    lags = [StructField(c, sales[TARGET].dataType) for c in LAG_COLUMNS]
    tie = [StructField("_tie", LongType())]
    own = [sales[c] for c in SALE_COLUMNS]
    return {
        SALES: StructType([*own, *lags, part]),
        TAILS: StructType([*own, *tie, part]),
    }


def _sale_schema() -> StructType:
    fields = {f.name: f for name in ("ventas", "promociones") for f in CLEAN_SCHEMAS[name].fields}
    return StructType([fields[c] for c in SALE_COLUMNS])


class SalesStore:
    """The store of sales with their history in ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, root)
        self.sale_schema = _sale_schema()
        self.schemas = _schemas(self.sale_schema)

    def months(self, table: str, now: Snapshot | None = None) -> list[str]:
        now = now or self.log.snapshot()
        return sorted(p.split("-", 1)[1] for p in now.parts if p.startswith(f"{table}-"))

    def _read(self, table: str, months: list[str], now: Snapshot) -> DataFrame:
        wanted = {f"{table}-{m}" for m in months}
        files = [f for f in now.files.values() if wanted & f.shares.keys()]
        return self.log.read(self.schemas[table], PART, files).drop(PART)

    def sales(self, version: int | None = None) -> DataFrame:
        """All stored sales with promotions and lags, as of the newest or an earlier commit."""
        now = self.log.snapshot(version)
        return self._read(SALES, self.months(SALES, now), now)

    def refresh(self, sales: DataFrame, promotions: DataFrame) -> Snapshot:
        """Add cleaned sales and the promotions of their keys. Sales that are stored already,
        equal in all columns, add nothing."""
        while True:
            now = self.log.snapshot()
            fresh = stage(self._fresh(sales, promotions, now), "fresh-sales")
            first = fresh.agg(F.min(_month()).alias("m")).first()["m"]
            if first is None:
                return now
            files, parts = self._changed(fresh, first, now)
            landed: list[bool] = []

            def entry(latest: Snapshot) -> dict | None:
                landed.clear()
                if latest.version != now.version:  # noqa: B023
                    return None  # another refresh came first: begin again on top of it
                landed.append(True)  # noqa: B023
                return {"parts": parts, "add": [asdict(f) for f in files]}  # noqa: B023

            after = self.log.commit(entry)
            if landed:
                return after

    def _fresh(self, sales: DataFrame, promotions: DataFrame, now: Snapshot) -> DataFrame:
        own = [c for c in SALE_COLUMNS if c in sales.columns]
        new = sales.select(*own).dropDuplicates()
        there = {r["m"] for r in new.select(_month().alias("m")).distinct().collect()}
        stored = self._read(SALES, sorted(there & set(self.months(SALES, now))), now)
        joined = attach_promotions(new.subtract(stored.select(*own)), promotions)
        return _conform(joined, self.sale_schema)

    def _changed(
        self, fresh: DataFrame, first: str, now: Snapshot
    ) -> tuple[list[DataFile], list[str]]:
        """Files of the months and states that change, and their parts."""
        groups = stage(fresh.select(*GROUP_KEYS).distinct(), "fresh-groups")
        later = [m for m in self.months(SALES, now) if m >= first]
        stored = self._read(SALES, later, now)
        earlier = [m for m in self.months(TAILS, now) if m < first]
        tails = self._read(TAILS, earlier[-1:], now)
        own = list(SALE_COLUMNS)
        # the history before the months that are read again, then all their rows
        affected = stage(
            stored.join(groups, list(GROUP_KEYS), "left_semi")
            .select(*own, F.lit(False).alias("_before"))
            .unionByName(fresh.withColumn("_before", F.lit(False)))
            .unionByName(
                tails.join(groups, list(GROUP_KEYS), "left_semi")
                .select(*own)
                .withColumn("_before", F.lit(True))
            ),
            "affected-sales",
        )
        renewed = stage(add_row_lags(affected).where("NOT _before").drop("_before"), "renewed-sales")
        kept = stored.join(groups, list(GROUP_KEYS), "left_anti")
        columns = [*own, *LAG_COLUMNS]
        changed = sorted(
            r["m"]
            for r in renewed.select(*columns)
            .exceptAll(stored.join(groups, list(GROUP_KEYS), "left_semi").select(*columns))
            .select(_month().alias("m"))
            .distinct()
            .collect()
        )
        rows = kept.select(*columns).unionByName(renewed.select(*columns))
        written = rows.where(_month().isin(changed)).withColumn(PART, _part(SALES, _month()))
        files = self.log.write(_conform(written, self.schemas[SALES]), PART, apart=True)
        months = sorted({*later, *changed})
        states = self._states(rows.select(*own), tails, months)
        files += self.log.write(_conform(states, self.schemas[TAILS]), PART, apart=True)
        parts = [f"{SALES}-{m}" for m in changed] + [f"{TAILS}-{m}" for m in months]
        return files, parts

    def _states(self, rows: DataFrame, tails: DataFrame, months: list[str]) -> DataFrame:
        """For the end of each of ``months`` the last rows of every store and product: those of
        the month, of the months before it and of the state before all."""
        tie = F.xxhash64(*SALE_COLUMNS)
        begin = rows.withColumn("_m", _month()).unionByName(
            tails.select(*SALE_COLUMNS).withColumn("_m", F.lit(""))
        )
        ranked = begin.withColumn("_tie", tie)
        newest = [F.desc("fecha"), F.desc("_tie")]
        # at most seven rows of a month matter to its state and those behind it
        in_month = Window.partitionBy(*GROUP_KEYS, "_m").orderBy(*newest)
        last = ranked.withColumn("_age", F.row_number().over(in_month)).where(F.col("_age") <= HISTORY)
        every = F.array(*[F.lit(m) for m in months])
        reached = F.filter(every, lambda m: m >= F.col("_m"))
        spread = last.withColumn("_state", F.explode(reached))
        by_state = Window.partitionBy(*GROUP_KEYS, "_state").orderBy(*newest)
        return (
            spread.withColumn("_age", F.row_number().over(by_state))
            .where(F.col("_age") <= HISTORY)
            .withColumn(PART, _part(TAILS, F.col("_state")))
        )

    def dataset(self, weather: DataFrame, products: DataFrame) -> DataFrame:
        """The 19-column dataset of the stored sales with cleaned weather and products, each with
        one row per key."""
        dimensions = measure((weather, "fecha"), (products, "id_producto"))
        if not all(d.unique for d in dimensions):
            raise ValueError("weather and products must have one row per key")
        stored = self.sales()
        complete = attach(drop_short_history(stored), *dimensions)
        over = attach(stored.select(*SALE_COLUMNS), dimensions[0])
        return add_calendar(fill_missing(complete, over=over)).select(*DATASET_COLUMNS)


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def refresh_dataset(spark: SparkSession, root: str, tables: RetailTables) -> Snapshot:
    """Add the sales and promotions of cleaned ``tables`` to the store in ``root``."""
    return SalesStore(spark, root).refresh(tables.ventas, tables.promociones)
