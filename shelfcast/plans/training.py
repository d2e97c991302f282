"""Splitting, training, evaluating and storing the demand model with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import iso_date
from shelfcast.operators.metrics import forecast_metrics
from shelfcast.operators.quantiles import discrete_quantile
from shelfcast.operators.requests import available_features, select_features
from shelfcast.schemas import TARGET
from shelfcast.sinks.audit import append_metrics
from shelfcast.sinks.tables import write_metrics_json
from shelfcast.sources.tables import read_model_dataset

# The forest of the model and the share of rows it learns from.
TREES, DEPTH, SEED = 100, 10, 42
TRAIN_PERCENT = 80
# Documented parameter: partitions of the training rows.
TRAIN_PARTITIONS = 32


def split_bucket() -> Column:
    """0 to 99, from a digest of the sale key: the same row always falls on the same side."""
    key = F.concat_ws("|", "id_tienda", "id_producto", iso_date("fecha"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100


def split_by_key(df: DataFrame, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    in_training = split_bucket() < percent
    return df.where(in_training), df.where(~in_training)


def split_by_time(df: DataFrame, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Train on the days up to the cut, test on the days after it."""
    days = df.select(F.unix_date("fecha").alias("day"))
    cut = discrete_quantile(days, "day", percent / 100).scalar()
    day = F.unix_date("fecha")
    return df.where(day <= cut), df.where(day > cut)


def _megabytes(size: str) -> int:
    """Megabytes of a memory setting such as 512m or 8g."""
    number, unit = size.lower().rstrip("ib").rstrip("kmgt"), size.lower().rstrip("ib")[-1]
    scale = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}.get(unit, 1 / 1024**2)
    return int(float(number) * scale)


def node_statistics_mb(spark: SparkSession) -> int:
    """Memory for the split statistics of one task: a quarter of its share of the heap, at most
    the default of Spark ML. With less of it training takes more passes, not more memory."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.master", "").startswith("local"):
        heap, tasks = conf.get("spark.driver.memory", "1g"), spark.sparkContext.defaultParallelism
    else:
        heap, tasks = conf.get("spark.executor.memory", "1g"), conf.get("spark.executor.cores", "1")
    return max(16, min(256, _megabytes(heap) // (4 * int(tasks))))


def forest_pipeline(
    features: list[str],
    *,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    statistics_mb: int = 256,
) -> Pipeline:
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    forest = RandomForestRegressor(
        labelCol=TARGET,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featureSubsetStrategy="all",
        maxMemoryInMB=statistics_mb,
    )
    return Pipeline(stages=[assembler, forest])


def _spread(df: DataFrame, partitions: int) -> DataFrame:
    """Bagging draws by partition and row, so both must follow from the data alone: rows go to
    a fixed number of partitions by their digest and are ordered there. The model is then the
    same whatever the partitions of the input and the number of cores."""
    return df.repartition(partitions, *df.columns).sortWithinPartitions(*df.columns)


def train_forest(
    train: DataFrame, *, partitions: int = TRAIN_PARTITIONS, **options: int
) -> PipelineModel:
    """Fit on the features present in ``train``, best a stored table: it is read several times.
    The model keeps the names of the features and their order. It depends on ``partitions``:
    choose it by the size of the data, not of the cluster."""
    options.setdefault("statistics_mb", node_statistics_mb(train.sparkSession))
    pipeline = forest_pipeline(available_features(train), **options)
    return pipeline.fit(_spread(select_features(train), partitions))


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    return forecast_metrics(model.transform(select_features(test)))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_job(
    spark: SparkSession,
    *,
    dataset_path: str,
    model_path: str,
    metrics_path: str,
    audit_root: str,
    run_id: str,
    **options: int,
) -> DataFrame:
    """Dataset in; model, metrics file and audit row out. Returns the one row of metrics."""
    train, test = split_by_key(read_model_dataset(spark, dataset_path))
    model = train_forest(train, **options)
    measured = evaluate(model, test)
    metrics = spark.createDataFrame([measured.first()], measured.schema)
    save_model(model, model_path)
    write_metrics_json(metrics, metrics_path)
    append_metrics(metrics, audit_root, run_id=run_id)
    return metrics
