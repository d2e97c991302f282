"""Medians, business summaries, error measures and top-n reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import METRICS
from shelfcast.operators.joins import attach_promotions
from shelfcast.operators.metrics import (
    forecast_metrics,
    mean_absolute_error,
    r_squared,
    root_mean_squared_error,
)
from shelfcast.operators.quantiles import approximate_quantile, discrete_quantile
from shelfcast.operators.summaries import (
    discount_levels,
    latest,
    mean_units_by,
    newest_first,
    promotion_share,
    row_counts,
    sales_ranges,
    weather_ranges,
)
from shelfcast.plans.dataset import model_dataset
from shelfcast.schemas import SALE_KEYS, TARGET
from shelfcast.sinks import audit
from shelfcast.sources.staging import new_path, stage
from shelfcast.sources.tables import preview


@query(
    "median_temperature",
    """SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY temperatura_media)
  AS temperatura_media FROM {clima_sucio}""",
)
def _(fx):
    return discrete_quantile(fx["clima_sucio"], "temperatura_media")


@query(
    "median_price",
    """SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY precio_unitario)
  AS precio_unitario FROM {ventas}""",
)
def _(fx):
    return discrete_quantile(fx["ventas"], "precio_unitario")


@query(
    "approximate_median_within_tolerance",
    "SELECT count(*) AS filas, count(*) > 0 AS dentro FROM {ventas}",
)
def _(fx):
    """The rank of the approximate median of the prices is within 1 % of the middle."""
    estimate = approximate_quantile(fx["ventas"], "precio_unitario", accuracy=1000).scalar()
    price = F.col("precio_unitario")
    below, upto = F.avg((price < estimate).cast("int")), F.avg((price <= estimate).cast("int"))
    return fx["ventas"].agg(
        F.count("*").alias("filas"), ((below <= 0.51) & (upto >= 0.49)).alias("dentro")
    )


@query(
    "units_by_store",
    "SELECT id_tienda, avg(unidades_vendidas) AS media_unidades FROM {dataset} GROUP BY 1",
)
def _(fx):
    return mean_units_by(model_dataset(fx.tables, columns=("id_tienda", TARGET)), "id_tienda")


@query(
    "units_by_promotion",
    """SELECT coalesce(promocion_activa, 0) AS promocion_activa,
       avg(unidades_vendidas) AS media_unidades
FROM {ventas} LEFT JOIN {promociones} USING (fecha, id_tienda, id_producto) GROUP BY 1""",
)
def _(fx):
    flagged = attach_promotions(fx["ventas"], fx["promociones"]).withColumn(
        "promocion_activa", F.coalesce("promocion_activa", F.lit(0))
    )
    return mean_units_by(flagged, "promocion_activa")


def _pair():
    return F.col(TARGET), F.col("lag_7")


def _errors(fx):
    """Units and their forecast alone: nothing else of the dataset is built."""
    return model_dataset(fx.tables, columns=(TARGET, "lag_7"))


@query(
    "mean_absolute_error",
    "SELECT avg(abs(unidades_vendidas - lag_7)) AS mae FROM {dataset}",
)
def _(fx):
    return _errors(fx).agg(mean_absolute_error(*_pair()).alias("mae"))


@query(
    "root_mean_squared_error",
    "SELECT sqrt(avg((unidades_vendidas - lag_7) ** 2)) AS rmse FROM {dataset}",
)
def _(fx):
    return _errors(fx).agg(root_mean_squared_error(*_pair()).alias("rmse"))


@query(
    "r_squared",
    """SELECT round(1 - avg((unidades_vendidas - lag_7) ** 2) / var_pop(unidades_vendidas), 9)
  AS r2 FROM {dataset}""",
)
def _(fx):
    return _errors(fx).agg(F.round(r_squared(*_pair()), 9).alias("r2"))


@query("forecast_metrics", f"SELECT {METRICS} FROM {{dataset}}")
def _(fx):
    return forecast_metrics(_errors(fx), TARGET, "lag_7")


@query(
    "row_counts",
    """SELECT 'ventas' AS tabla, count(*) AS filas FROM {ventas}
UNION ALL SELECT 'promociones', count(*) FROM {promociones}
UNION ALL SELECT 'clima', count(*) FROM {clima}
UNION ALL SELECT 'productos', count(*) FROM {productos}""",
)
def _(fx):
    return row_counts(fx.tables)


@query(
    "weather_ranges",
    """SELECT min(temperatura_media) AS temperatura_min, max(temperatura_media) AS temperatura_max,
       min(lluvia_mm) AS lluvia_min, max(lluvia_mm) AS lluvia_max FROM {clima}""",
)
def _(fx):
    return weather_ranges(fx["clima"])


@query(
    "sales_ranges",
    """SELECT min(unidades_vendidas) AS unidades_min, max(unidades_vendidas) AS unidades_max,
       avg(unidades_vendidas) AS unidades_media,
       min(precio_unitario) AS precio_min, max(precio_unitario) AS precio_max FROM {ventas}""",
)
def _(fx):
    return sales_ranges(fx["ventas"])


@query(
    "promotion_share",
    """SELECT count(*) FILTER (promocion_activa = 1) AS activas,
       100.0::DOUBLE * count(*) FILTER (promocion_activa = 1) / count(*) AS porcentaje
FROM {promociones_sucias}""",
)
def _(fx):
    return promotion_share(fx["promociones_sucias"])


@query(
    "discount_levels",
    "SELECT DISTINCT descuento_pct FROM {promociones_sucias} WHERE descuento_pct > 0",
)
def _(fx):
    return discount_levels(fx["promociones_sucias"])


def _dated_predictions(fx):
    """Sales of the dense table as predictions with a time and an id."""
    return fx["ventas_densas"].select(
        F.col("fecha").alias("fecha_prediccion"),
        (F.col("id_tienda") * 100 + F.col("id_producto")).alias("id"),
        F.col(TARGET).alias("prediccion_unidades"),
    )


@query(
    "latest_predictions",
    """SELECT fecha AS fecha_prediccion, id_tienda * 100 + id_producto AS id,
       unidades_vendidas AS prediccion_unidades
FROM {ventas_densas} ORDER BY fecha DESC, id DESC LIMIT 10""",
)
def _(fx):
    return latest(_dated_predictions(fx), "fecha_prediccion", 10)


@query(
    "metrics_history",
    f"SELECT anio AS id, make_date(anio, 12, 31) AS fecha_entrenamiento, {METRICS} "
    "FROM {dataset} GROUP BY anio ORDER BY 2 DESC",
)
def _(fx):
    """One evaluation per year of the data, newest first."""
    pair = _pair()
    yearly = (
        model_dataset(fx.tables)
        .groupBy(F.col("anio").alias("id"))
        .agg(
            F.round(mean_absolute_error(*pair), 4).alias("mae"),
            F.round(root_mean_squared_error(*pair), 4).alias("rmse"),
            F.round(r_squared(*pair), 4).alias("r2"),
        )
        .withColumn("fecha_entrenamiento", F.make_date("id", F.lit(12), F.lit(31)))
    )
    return newest_first(yearly, "fecha_entrenamiento")


def _audit_root(fx):
    root = new_path(fx.spark, "audit")
    audit.create_tables(fx.spark, root)
    return root


@query(
    "latest_audited_predictions",
    "SELECT 'r2' AS run_id, least(count(*), 10) AS filas FROM {dataset}",
)
def _(fx):
    """Two runs into the prediction table: the latest ten rows are of the second."""
    root = _audit_root(fx)
    forecast = stage(model_dataset(fx.tables).withColumn("prediction", F.col("lag_7")), "forecast")
    for run in ("r1", "r2"):
        audit.append_predictions(forecast, root, run_id=run)
    rows = latest(audit.read_audit(fx.spark, root, "predicciones"), "fecha_prediccion", 10)
    return rows.groupBy("run_id").agg(F.count("*").alias("filas"))


@query(
    "audited_metrics_history",
    f"""SELECT run_id, lugar, mae, rmse, r2 FROM (SELECT {METRICS} FROM {{dataset}})
CROSS JOIN (VALUES ('r3', 1), ('r2', 2), ('r1', 3)) t(run_id, lugar)""",
)
def _(fx):
    """The evaluations of three runs in the metrics table, newest first."""
    root = _audit_root(fx)
    metrics = stage(forecast_metrics(model_dataset(fx.tables), TARGET, "lag_7"), "metrics")
    for run in ("r1", "r2", "r3"):
        audit.append_metrics(metrics, root, run_id=run)
    history = newest_first(audit.read_audit(fx.spark, root, "metricas_modelo"), "fecha_entrenamiento")
    place = F.row_number().over(Window.orderBy(F.desc("fecha_entrenamiento")))  # a row per run
    return history.select("run_id", place.alias("lugar"), "mae", "rmse", "r2")


@query(
    "audited_dataset_first_rows",
    """SELECT * EXCLUDE (descuento_pct), CAST(descuento_pct AS DOUBLE) AS descuento_pct,
       'r1' AS run_id FROM {dataset} ORDER BY fecha, id_tienda, id_producto LIMIT 5""",
)
def _(fx):
    root = _audit_root(fx)
    audit.append_dataset(model_dataset(fx.tables), root, run_id="r1")
    rows = audit.read_audit(fx.spark, root, "dataset_modelo")
    return preview(rows, list(SALE_KEYS), 5).drop("id")
