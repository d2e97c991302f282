"""Cleaning, stated as rules per table and applied by one function.

Filters stand after the duplicate removal, but they only read its grouping columns,
so Catalyst moves them below it and into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse_date
from shelfcast.operators.dedup import drop_identical_rows
from shelfcast.sources.tables import RetailTables

Bounds = tuple[float | None, float | None]


@dataclass(frozen=True)
class CleaningRules:
    """What a valid row of a table looks like; rules on absent columns do not apply."""

    required: tuple[str, ...]
    defaults: Mapping[str, int | str] = field(default_factory=dict)
    bounds: Mapping[str, Bounds] = field(default_factory=dict)


# Keys, defaults and ranges of the four tables.
RULES = {
    "ventas": CleaningRules(
        required=("fecha", "id_tienda", "id_producto", "unidades_vendidas"),
        bounds={"unidades_vendidas": (0, None), "precio_unitario": (0, None)},
    ),
    "promociones": CleaningRules(
        required=("fecha", "id_tienda", "id_producto", "promocion_activa"),
        defaults={"descuento_pct": 0},
        bounds={"descuento_pct": (0, 100)},
    ),
    "clima": CleaningRules(
        required=("fecha",),
        defaults={"lluvia_mm": 0},
        bounds={"lluvia_mm": (0, None)},
    ),
    "productos": CleaningRules(
        required=("id_producto",),
        defaults={"nombre_producto": "Desconocido", "categoria": "Sin categoria"},
    ),
}


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column (NaN is no value)."""
    return df.dropna(subset=list(columns))


def fill_defaults(df: DataFrame, defaults: Mapping[str, int | str]) -> DataFrame:
    """NULL becomes the default; the column keeps its type, and NaN is left alone."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()})


def keep_in_bounds(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """Rows whose values lie within the inclusive bounds; NULL lies in none."""
    for column, (low, high) in bounds.items():
        if column not in df.columns:
            continue
        if low is not None:
            df = df.where(F.col(column) >= low)
        if high is not None:
            df = df.where(F.col(column) <= high)
    return df


def clean(df: DataFrame, rules: CleaningRules) -> DataFrame:
    if "fecha" in rules.required:
        df = parse_date(df)
    df = require_values(drop_identical_rows(df), rules.required)
    # defaults first: a NULL discount is "no discount", not an invalid one
    return keep_in_bounds(fill_defaults(df, rules.defaults), rules.bounds)


def clean_table(name: str, df: DataFrame) -> DataFrame:
    return clean(df, RULES[name])


def clean_tables(tables: RetailTables) -> RetailTables:
    return tables.map(clean_table)


def promotion_slice(df: DataFrame, active: bool) -> DataFrame:
    """Rows sold with, or without, a promotion."""
    return df.where(F.col("promocion_activa") == int(active))
