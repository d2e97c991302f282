"""Feature vectors, splits, training, scoring and the request stream."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.operators.requests import REASONS
from shelfcast.plans.dataset import model_dataset
from shelfcast.plans.scoring import predict, score_requests
from shelfcast.plans.training import (
    evaluate,
    load_model,
    save_model,
    split_by_key,
    split_by_time,
    train_forest,
    train_job,
)
from shelfcast.schemas import FEATURES, SALE_KEYS, TARGET
from shelfcast.sinks.audit import create_tables, read_audit
from shelfcast.sinks.tables import write_dataset, write_table
from shelfcast.sources.staging import new_path, stage
from shelfcast.sources.tables import read_table
from shelfcast.streaming.requests import BATCH, read_requests, score_stream

FEATURE_LIST = ", ".join(FEATURES)
_BUCKET = """(CAST('0x' || substr(md5(concat_ws('|', id_tienda, id_producto,
    strftime(fecha, '%Y-%m-%d'))), 1, 8) AS BIGINT) % 100)"""


@query(
    "feature_vectors",
    "SELECT fecha, id_tienda, id_producto, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f_{i}" for i, c in enumerate(FEATURES))
    + " FROM {dataset}",
)
def _(fx):
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    values = vector_to_array("features")
    return assembler.transform(model_dataset(fx.tables)).select(
        *SALE_KEYS, *(values[i].alias(f"f_{i}") for i in range(len(FEATURES)))
    )


def _labelled(train, test):
    keys = list(SALE_KEYS)
    return (
        train.select(*keys, F.lit("train").alias("parte"))
        .unionByName(test.select(*keys, F.lit("test").alias("parte")))
    )


@query(
    "split_by_key",
    f"""SELECT fecha, id_tienda, id_producto,
       CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS parte FROM {{ventas}}""",
)
def _(fx):
    return _labelled(*split_by_key(fx["ventas"]))


@query(
    "split_by_time",
    """SELECT fecha, id_tienda, id_producto, CASE WHEN fecha <= (
         SELECT percentile_disc(0.8) WITHIN GROUP (ORDER BY fecha) FROM {ventas})
       THEN 'train' ELSE 'test' END AS parte FROM {ventas}""",
)
def _(fx):
    return _labelled(*split_by_time(fx["ventas"]))


_DATASETS: dict[tuple[str, str], DataFrame] = {}
_TRAINED: dict[tuple[str, str], str] = {}


def _dataset(fx):
    """Dataset of a data directory, stored once per application."""
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    if key not in _DATASETS:
        _DATASETS[key] = stage(model_dataset(fx.tables), "dataset")
    return _DATASETS[key]


def _trained(fx):
    """Dataset and model of a data directory, trained once per application."""
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    dataset = _dataset(fx)
    if key not in _TRAINED:
        train, _ = split_by_key(dataset)
        path = new_path(fx.spark, "model")
        save_model(train_forest(train), path)
        _TRAINED[key] = path
    return dataset, load_model(_TRAINED[key])


def _in_range(dataset, column="prediction"):
    """A forest predicts means of training units, so never beyond the least and the largest."""
    train, _ = split_by_key(dataset)
    low = train.agg(F.min(TARGET)).scalar()
    high = train.agg(F.max(TARGET)).scalar()
    value = F.col(column)
    # means are sums of rounded numbers
    inside = ~F.isnan(value) & (value >= low - 1e-9) & (value <= high + 1e-9)
    return inside.alias("en_rango")


@query(
    "forest_evaluation",
    f"""SELECT count(*) AS filas, TRUE AS mejor_que_la_media, TRUE AS mae_hasta_rmse
FROM {{dataset}} WHERE {_BUCKET} >= 80""",
)
def _(fx):
    """Rows of the test part; the error is below that of predicting their mean."""
    dataset, model = _trained(fx)
    _, test = split_by_key(dataset)
    measured = evaluate(model, test)
    rows = test.agg(F.count("*").alias("filas"), F.stddev_pop(TARGET).alias("sd"))
    return rows.crossJoin(measured).select(  # one row each
        "filas",
        (F.col("rmse") < F.col("sd")).alias("mejor_que_la_media"),
        (F.col("mae") <= F.col("rmse")).alias("mae_hasta_rmse"),
    )


@query(
    "forest_predictions",
    f"""SELECT fecha, id_tienda, id_producto, unidades_vendidas, TRUE AS en_rango
FROM {{dataset}} WHERE {_BUCKET} >= 80""",
)
def _(fx):
    """Every row of the test part with a prediction within the units of the training part."""
    dataset, model = _trained(fx)
    _, test = split_by_key(dataset)
    return predict(model, test).select(*SALE_KEYS, TARGET, _in_range(dataset))


@query(
    "score_request_batch",
    f"SELECT {FEATURE_LIST}, TRUE AS en_rango FROM {{peticiones_revisadas}} WHERE motivos = ''",
)
def _(fx):
    dataset, model = _trained(fx)
    scored, _ = score_requests(model, fx["peticiones"], new_path(fx.spark, "audit"), run_id="r1")
    # answers are rounded to two decimals
    rounded = scored.withColumnRenamed("prediccion_unidades_vendidas", "prediction")
    train, _ = split_by_key(dataset)
    low = train.agg(F.floor(F.min(TARGET))).scalar()
    high = train.agg(F.ceil(F.max(TARGET))).scalar()
    value = F.col("prediction")
    return rounded.select(
        *FEATURES, (~F.isnan(value) & (value >= low) & (value <= high)).alias("en_rango")
    )


@query(
    "train_job",
    """SELECT TRUE AS archivo_igual, TRUE AS auditoria_igual, TRUE AS mejor_que_la_media""",
)
def _(fx):
    """The metrics returned, in the file and in the audit table agree, and beat the mean. The job
    trains its own forest; none but that one is needed."""
    dataset = _dataset(fx)
    paths = {n: new_path(fx.spark, n) for n in ("dataset", "model", "metrics", "audit")}
    write_dataset(dataset, paths["dataset"])
    metrics = train_job(
        fx.spark,
        dataset_path=paths["dataset"],
        model_path=paths["model"],
        metrics_path=paths["metrics"],
        audit_root=paths["audit"],
        run_id="r1",
    )
    names = ("mae", "rmse", "r2")
    returned = metrics.select(*(F.col(c).cast("double") for c in names))
    file = read_table(fx.spark, paths["metrics"], fmt="json").select(
        *(F.col(k).alias(f"file_{c}") for c, k in zip(names, ("MAE", "RMSE", "R2"), strict=True))
    )
    audited = read_audit(fx.spark, paths["audit"], "metricas_modelo").select(
        *(F.col(c).alias(f"audit_{c}") for c in names)
    )
    _, test = split_by_key(dataset)
    sd = test.agg(F.stddev_pop(TARGET).alias("sd"))

    def same(prefix):
        return reduce(and_, (F.col(c) == F.col(f"{prefix}_{c}") for c in names))

    # one row each
    return returned.crossJoin(file).crossJoin(audited).crossJoin(sd).select(
        same("file").alias("archivo_igual"),
        same("audit").alias("auditoria_igual"),
        (F.col("rmse") < F.col("sd")).alias("mejor_que_la_media"),
    )


# What was audited besides the prediction itself: all valid requests and no others.
_AUDITED = f"""SELECT {FEATURE_LIST}, make_date(anio, mes, dia) AS fecha_objetivo, TRUE AS predicha
FROM {{peticiones_revisadas}} WHERE motivos = ''"""


def _audited(rows):
    predicted = F.col("prediccion_unidades").isNotNull() & ~F.isnan("prediccion_unidades")
    return rows.select(*FEATURES, "fecha_objetivo", predicted.alias("predicha"))


@query("audited_request_batch", _AUDITED)
def _(fx):
    _, model = _trained(fx)
    root = new_path(fx.spark, "audit")
    score_requests(model, fx["peticiones"], root, run_id="r1")
    return _audited(read_audit(fx.spark, root, "predicciones"))


def _request_files(fx):
    path = new_path(fx.spark, "requests")
    write_table(fx["peticiones"], path, fmt="json")
    return path


def _streamed(fx, root, rejected, run_id="s1"):
    _, model = _trained(fx)
    checked = read_requests(fx.spark, _request_files(fx))
    marks = new_path(fx.spark, "stream")
    score_stream(checked, model, root, rejected, marks, run_id=run_id).awaitTermination()


def _places(fx):
    root, rejected = new_path(fx.spark, "audit"), new_path(fx.spark, "stream-rejected")
    create_tables(fx.spark, root)
    return root, rejected


@query(
    "score_request_stream",
    f"SELECT {FEATURE_LIST}, TRUE AS en_rango FROM {{peticiones_revisadas}} WHERE motivos = ''",
)
def _(fx):
    dataset, _ = _trained(fx)
    root, rejected = _places(fx)
    _streamed(fx, root, rejected)
    rows = read_audit(fx.spark, root, "predicciones")
    return rows.select(*FEATURES, _in_range(dataset, "prediccion_unidades"))


@query("audited_request_stream", _AUDITED)
def _(fx):
    root, rejected = _places(fx)
    _streamed(fx, root, rejected)
    return _audited(read_audit(fx.spark, root, "predicciones"))


@query(
    "audited_batch_and_stream",
    f"""SELECT {FEATURE_LIST}, fecha_objetivo, predicha, corrida
FROM ({_AUDITED}) CROSS JOIN (VALUES ('r1'), ('s1-0')) t(corrida)""",
)
def _(fx):
    """A batch and then a stream into one audit table: both can be read from it."""
    _, model = _trained(fx)
    root, rejected = _places(fx)
    score_requests(model, fx["peticiones"], root, run_id="r1")
    _streamed(fx, root, rejected)
    rows = read_audit(fx.spark, root, "predicciones")
    predicted = F.col("prediccion_unidades").isNotNull() & ~F.isnan("prediccion_unidades")
    return rows.select(
        *FEATURES,
        "fecha_objetivo",
        predicted.alias("predicha"),
        F.col("run_id").alias("corrida"),
    )


@query(
    "quarantine_request_stream",
    f"SELECT {FEATURE_LIST}, motivos FROM {{peticiones_revisadas}} WHERE motivos <> ''",
)
def _(fx):
    root, rejected = _places(fx)
    _streamed(fx, root, rejected)
    rows = read_table(fx.spark, rejected, fmt="parquet").drop(BATCH)
    return rows.withColumn(REASONS, F.concat_ws(",", REASONS))
