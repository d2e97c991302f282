"""From raw tables to the feature dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfcast.functions.calendar import add_calendar
from shelfcast.operators.cleaning import clean_tables
from shelfcast.operators.fills import fill_missing, fill_zeros
from shelfcast.operators.joins import attach, attach_promotions, measure
from shelfcast.operators.lags import add_calendar_lags, add_row_lags, drop_short_history
from shelfcast.schemas import CLEAN_SCHEMAS, DATASET_COLUMNS
from shelfcast.sources.staging import stage, stage_all
from shelfcast.sources.tables import RetailTables


def model_dataset(
    tables: RetailTables,
    *,
    staged: bool = True,
    calendar_lags: bool = False,
    exact: bool = True,
    full_history_only: bool = True,
    already_clean: bool = False,
    columns: Sequence[str] = DATASET_COLUMNS,
) -> DataFrame:
    """The 19-column dataset: one row per sale, by default only those that have a history; of
    its columns only ``columns``, without the joins and the median that none of them needs.

    The order of the steps is chosen for the one wide shuffle, that of the history windows.
    They need nothing but the sale, so weather and products, if each key has one row, join
    the result of the windows, without a shuffle; calendar columns are computed there too.
    Where keys repeat, the joins multiply rows and have to come first.

    Group sizes, median and windows all read the joined sales. Staged, these are written to
    the shared folder once; otherwise every reader runs the joins again.
    """
    cleaned = tables if already_clean else clean_tables(tables)
    sales = attach_promotions(cleaned.ventas, cleaned.promociones)
    weather, products = cleaned.clima, cleaned.productos
    if staged:
        sales, weather, products = stage_all(sales=sales, weather=weather, products=products)
    dimensions = measure((weather, "fecha"), (products, "id_producto"))
    join_late = all(d.unique for d in dimensions)

    rows, late = sales, []
    if join_late:
        # a join on unique keys that adds no wanted column changes nothing
        late = [d for d, t in zip(dimensions, ("clima", "productos"), strict=True) if _adds(t, columns)]
    else:
        rows = attach(sales, *dimensions)
        rows = stage(rows, "joined") if staged else rows
    complete = add_calendar_lags(rows) if calendar_lags else add_row_lags(rows)
    if full_history_only:
        complete = drop_short_history(complete)
    complete = attach(complete, *late)
    if _adds("clima", columns):
        rows = attach(rows, dimensions[0]) if join_late else rows
        complete = fill_missing(complete, over=rows, exact=exact)
    else:
        complete = fill_zeros(complete)
    return add_calendar(complete).select(*columns)


def _adds(table: str, columns: Sequence[str]) -> bool:
    """Whether one of ``columns`` comes from the dimension."""
    own = set(CLEAN_SCHEMAS[table].names) - {"fecha", "id_producto"}
    return bool(own & set(columns))
