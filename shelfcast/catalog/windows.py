"""History features, each alone, together, and on the paths for hot groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import day_history, row_history
from shelfcast.operators.lags import add_calendar_lags, add_row_lags
from shelfcast.plans.dataset import model_dataset
from shelfcast.sources.staging import stage


@query(
    "lag_1",
    """SELECT *, lag(unidades_vendidas, 1)
  OVER (PARTITION BY id_tienda, id_producto ORDER BY fecha) AS lag_1 FROM {ventas}""",
)
def _(fx):
    return add_row_lags(fx["ventas"]).drop("lag_7", "media_movil_7")


@query(
    "lag_7",
    """SELECT *, lag(unidades_vendidas, 7)
  OVER (PARTITION BY id_tienda, id_producto ORDER BY fecha) AS lag_7 FROM {ventas}""",
)
def _(fx):
    return add_row_lags(fx["ventas"]).drop("lag_1", "media_movil_7")


@query(
    "rolling_mean_7",
    """SELECT *, avg(unidades_vendidas) OVER (PARTITION BY id_tienda, id_producto ORDER BY fecha
  ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS media_movil_7 FROM {ventas}""",
)
def _(fx):
    return add_row_lags(fx["ventas"]).drop("lag_1", "lag_7")


@query("row_lags", row_history("{ventas}"))
def _(fx):
    return add_row_lags(fx["ventas"])


@query("row_lags_in_blocks", row_history("{ventas}"))
def _(fx):
    """All groups of 30 rows and more count as hot."""
    return add_row_lags(stage(fx["ventas"], "ventas"), hot_rows=30, block_rows=10)


@query("calendar_lags", day_history("{ventas}"))
def _(fx):
    return add_calendar_lags(fx["ventas"])


@query("calendar_lags_by_day", day_history("{ventas}"))
def _(fx):
    return add_calendar_lags(stage(fx["ventas"], "ventas"))


@query("calendar_lags_dense", day_history("{ventas_densas}"))
def _(fx):
    return add_calendar_lags(fx["ventas_densas"])


@query("model_dataset", "SELECT * FROM {dataset}")
def model_dataset_query(fx):
    return model_dataset(fx.tables)


@query(
    "lags_whatever_is_joined",
    "SELECT count(*) AS filas, count(*) AS iguales FROM {ventas_doble}",
)
def _(fx):
    """History of tied sales with and without the columns of a weather table in the row."""
    sales = fx["ventas_doble"]
    plain = add_row_lags(sales)
    wide = add_row_lags(sales.join(fx["clima"], "fecha", "left")).select(*plain.columns)
    same = plain.intersectAll(wide).count()
    return plain.agg(F.count("*").alias("filas")).withColumn("iguales", F.lit(same))


@query("model_dataset_single_plan", "SELECT * FROM {dataset}")
def _(fx):
    return model_dataset(fx.tables, staged=False)


@query("model_dataset_calendar_lags", "SELECT * FROM {dataset_por_dia}")
def _(fx):
    return model_dataset(fx.tables, calendar_lags=True)
