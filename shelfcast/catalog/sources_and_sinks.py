"""Queries that write tables to the shared folder and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfcast.catalog.fixtures import Fixtures
from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import METRICS, clean_sales
from shelfcast.operators.cleaning import clean_table, clean_tables
from shelfcast.operators.joins import merge_tables
from shelfcast.operators.metrics import forecast_metrics
from shelfcast.plans.dataset import model_dataset
from shelfcast.schemas import DATASET_COLUMNS, RAW_SCHEMAS
from shelfcast.sinks import audit
from shelfcast.sinks.tables import write_dataset, write_metrics_json, write_table
from shelfcast.sources.staging import new_path
from shelfcast.sources.tables import (
    RetailTables,
    preview,
    read_clean_tables,
    read_model_dataset,
    read_raw_tables,
    read_table,
)


def _raw_tables(fx: Fixtures) -> RetailTables:
    """Tables with the decimals and empty fields of raw files, columns in reverse order."""
    tables = RetailTables(
        fx["ventas_crudas"], fx["promociones_crudas"], fx["clima"], fx["productos"]
    )
    return tables.map(lambda _, df: df.select(*reversed(df.columns)))


def _csv_files(fx: Fixtures, tables: RetailTables) -> dict[str, str]:
    paths = {}
    for name, df in tables.as_dict().items():
        paths[name] = new_path(fx.spark, f"{name}-csv")
        write_table(df, paths[name], fmt="csv")
    return paths


def _content(tables: RetailTables) -> DataFrame:
    """Per table and column: rows, values, and the sum of the values in hundredths (of texts
    and dates the sum of their lengths)."""
    parts = []
    for name, df in tables.as_dict().items():
        for column, kind in df.dtypes:
            value = F.round(F.col(column) * 100) if kind in ("int", "double") else F.length(
                F.col(column).cast("string")
            )
            parts.append(
                df.agg(
                    F.lit(name).alias("tabla"),
                    F.lit(column).alias("columna"),
                    F.count("*").alias("filas"),
                    F.count(column).alias("valores"),
                    F.sum(value.cast("long")).alias("suma"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def _content_sql(sources: dict[str, str]) -> str:
    parts = []
    for name, source in sources.items():
        for f in RAW_SCHEMAS[name].fields:
            text = isinstance(f.dataType, StringType)
            value = f"length(CAST({f.name} AS VARCHAR))" if text else f"round({f.name} * 100)"
            parts.append(
                f"SELECT '{name}' AS tabla, '{f.name}' AS columna, count(*) AS filas, "
                f"count({f.name}) AS valores, CAST(sum(CAST({value} AS BIGINT)) AS BIGINT) AS suma "
                f"FROM {source}"
            )
    return "\nUNION ALL\n".join(parts)


@query(
    "csv_scan",
    """SELECT CAST(fecha AS VARCHAR) AS fecha, id_tienda, id_producto,
       CAST(unidades_vendidas AS DOUBLE) AS unidades_vendidas, precio_unitario
FROM {ventas_crudas}""",
)
def _(fx):
    paths = _csv_files(fx, _raw_tables(fx))
    return read_table(fx.spark, paths["ventas"], schema=RAW_SCHEMAS["ventas"])


@query(
    "csv_scan_promotions",
    """SELECT CAST(fecha AS VARCHAR) AS fecha, id_tienda, id_producto, promocion_activa,
       CAST(descuento_pct AS DOUBLE) AS descuento_pct FROM {promociones_crudas}""",
)
def _(fx):
    paths = _csv_files(fx, _raw_tables(fx))
    return read_raw_tables(fx.spark, paths).promociones


@query("csv_scan_inferred", "SELECT fecha, temperatura_media, lluvia_mm FROM {clima}")
def _(fx):
    path = new_path(fx.spark, "clima-csv")
    write_table(fx["clima"], path, fmt="csv")
    return read_table(fx.spark, path)


_RAW = {
    "ventas": "{ventas_crudas}",
    "promociones": "{promociones_crudas}",
    "clima": "{clima}",
    "productos": "{productos}",
}
_CLEAN = {name: f"{{{name}_de_crudas}}" for name in _RAW}


@query("load_raw_tables", _content_sql(_RAW))
def _(fx):
    return _content(read_raw_tables(fx.spark, _csv_files(fx, _raw_tables(fx))))


def _clean_from_csv(fx: Fixtures) -> RetailTables:
    """Raw files, cleaned, written as CSV and read back."""
    raw = read_raw_tables(fx.spark, _csv_files(fx, _raw_tables(fx)))
    return read_clean_tables(fx.spark, _csv_files(fx, clean_tables(raw)), fmt="csv")


@query("load_clean_tables", _content_sql(_CLEAN))
def _(fx):
    return _content(_clean_from_csv(fx))


@query("load_clean_sales", "SELECT * FROM {ventas_de_crudas}")
def _(fx):
    return _clean_from_csv(fx).ventas


@query("load_clean_promotions", "SELECT * FROM {promociones_de_crudas}")
def _(fx):
    return _clean_from_csv(fx).promociones


@query("write_clean_table", clean_sales("{ventas_sucias}"))
def _(fx):
    path = new_path(fx.spark, "ventas-limpio")
    write_table(clean_table("ventas", fx["ventas_sucias"]), path)
    return read_table(fx.spark, path, fmt="parquet")


@query("write_dataset_by_month", "SELECT anio, mes, count(*) AS filas FROM {dataset} GROUP BY 1, 2")
def _(fx):
    path = new_path(fx.spark, "dataset")
    write_dataset(model_dataset(fx.tables), path)
    return (
        read_model_dataset(fx.spark, path)
        .groupBy("anio", "mes")
        .agg(F.count("*").alias("filas"))
    )


@query("load_model_dataset", "SELECT * FROM {dataset}")
def _(fx):
    path = new_path(fx.spark, "dataset")
    write_dataset(model_dataset(fx.tables), path)
    return read_model_dataset(fx.spark, path).select(*DATASET_COLUMNS)


_FIRST_KEYS = ["fecha", "id_tienda", "id_producto"]


@query("preview_rows", "SELECT * FROM {ventas} ORDER BY fecha, id_tienda, id_producto LIMIT 5")
def _(fx):
    return preview(fx["ventas"], _FIRST_KEYS, 5)


@query(
    "dataset_first_rows",
    "SELECT * FROM {dataset} ORDER BY fecha, id_tienda, id_producto LIMIT 5",
)
def _(fx):
    return preview(model_dataset(fx.tables), _FIRST_KEYS, 5)


def _audit_root(fx: Fixtures) -> str:
    root = new_path(fx.spark, "audit")
    audit.create_tables(fx.spark, root)
    return root


def _naive_forecast(fx: Fixtures) -> DataFrame:
    """Each sale with the units of seven rows before as its forecast."""
    return model_dataset(fx.tables).withColumn("prediction", F.col("lag_7"))


@query(
    "audit_append_dataset",
    """SELECT * EXCLUDE (descuento_pct), CAST(descuento_pct AS DOUBLE) AS descuento_pct,
       'r1' AS run_id FROM {dataset}""",
)
def _(fx):
    root = _audit_root(fx)
    dataset = model_dataset(fx.tables)
    for _ in range(2):  # the second time replaces the run
        audit.append_dataset(dataset, root, run_id="r1")
    return audit.read_audit(fx.spark, root, "dataset_modelo").drop("id")


@query(
    "audit_ids_are_unique",
    """SELECT count(*) AS filas, count(*) AS ids FROM {unidas_repetidas}""",
)
def _(fx):
    """Ids of a dataset in which promotions that occur twice make equal rows."""
    root = _audit_root(fx)
    tables = clean_tables(fx.tables)
    twice = tables.promociones.unionByName(tables.promociones)
    rows = merge_tables(RetailTables(tables.ventas, twice, tables.clima, tables.productos))
    for name in DATASET_COLUMNS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None))
    audit.append_dataset(rows, root, run_id="r1")
    stored = audit.read_audit(fx.spark, root, "dataset_modelo")
    return stored.agg(F.count("*").alias("filas"), F.count_distinct("id").alias("ids"))


@query(
    "audit_append_predictions",
    """SELECT fecha AS fecha_objetivo, id_tienda, id_producto, lag_7 AS prediccion_unidades,
       precio_unitario, promocion_activa, CAST(descuento_pct AS DOUBLE) AS descuento_pct,
       temperatura_media, lluvia_mm, anio, mes, dia, dia_semana, es_fin_de_semana,
       lag_1, lag_7, media_movil_7, 'r1' AS run_id
FROM {dataset}""",
)
def _(fx):
    root = _audit_root(fx)
    audit.append_predictions(_naive_forecast(fx), root, run_id="r1")
    return audit.read_audit(fx.spark, root, "predicciones").drop("id", "fecha_prediccion")


@query(
    "audit_append_metrics",
    f"SELECT 'SeasonalNaive' AS algoritmo, {METRICS}, 'r1' AS run_id FROM {{dataset}}",
)
def _(fx):
    root = _audit_root(fx)
    audit.append_metrics(
        forecast_metrics(_naive_forecast(fx)), root, run_id="r1", algorithm="SeasonalNaive"
    )
    return audit.read_audit(fx.spark, root, "metricas_modelo").drop("id", "fecha_entrenamiento")


@query(
    "metrics_json",
    f"SELECT mae AS \"MAE\", rmse AS \"RMSE\", r2 AS \"R2\" FROM (SELECT {METRICS} FROM {{dataset}})",
)
def _(fx):
    path = new_path(fx.spark, "metrics")
    write_metrics_json(forecast_metrics(_naive_forecast(fx)), path)
    return read_table(fx.spark, path, fmt="json")
