"""Calendar features of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark numbers the days from Sunday = 1 to Saturday = 7.
WEEKEND_DAYS = (1, 7)


def weekend_flag(day_of_week: Column) -> Column:
    return day_of_week.isin(*WEEKEND_DAYS).cast("int")


def calendar_columns(date: str = "fecha") -> dict[str, Column]:
    weekday = F.dayofweek(date)
    return {
        "anio": F.year(date),
        "mes": F.month(date),
        "dia": F.dayofmonth(date),
        "dia_semana": weekday,
        "es_fin_de_semana": F.coalesce(weekend_flag(weekday), F.lit(0)),
    }


def add_calendar(df: DataFrame, date: str = "fecha") -> DataFrame:
    return df.withColumns(calendar_columns(date))
