"""Date parsing, building, spines and formatting."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType


def parse_date(df: DataFrame, column: str = "fecha") -> DataFrame:
    """Type a date column; text that is no date becomes NULL instead of failing the job."""
    if isinstance(df.schema[column].dataType, DateType):
        return df
    return df.withColumn(column, F.try_to_date(column))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of a year, month and day; NULL where they name no day."""
    return F.try_to_date(F.format_string("%d-%02d-%02d", year, month, day))


def days_between(first: Column | datetime.date | str, last: Column | datetime.date | str) -> Column:
    """Array of all days from ``first`` to ``last``, both included."""
    start, end = (c if isinstance(c, Column) else F.lit(c).cast("date") for c in (first, last))
    return F.sequence(start, end, F.expr("interval 1 day"))


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day."""
    return spark.range(1).select(F.explode(days_between(first, last)).alias("fecha"))


def iso_date(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
