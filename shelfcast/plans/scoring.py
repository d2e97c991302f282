"""Scoring batches of requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.requests import (
    REASONS,
    check_requests,
    model_input,
    rejected_requests,
    valid_requests,
)
from shelfcast.plans.training import model_features
from shelfcast.sinks.audit import append_predictions
from shelfcast.sources.staging import stage


def predict(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Typed requests with their ``prediction``; columns that are no feature, such as the id of
    a request, are carried along."""
    features = model_features(model)
    model_input(requests, features)  # names what is missing
    own = {"features", "prediction"} & set(requests.columns)
    if own:
        raise ValueError(f"columns reserved for the model: {sorted(own)}")
    return model.transform(requests).drop("features")


def predict_one(spark: SparkSession, model: PipelineModel, request: Mapping) -> float:
    """Prediction for a single request, for trying out a model."""
    features = model_features(model)
    raw = spark.range(1).select(*(F.lit(str(v)).alias(name) for name, v in request.items()))
    checked = check_requests(model_input(raw, features))
    faults = [name for name in checked.first()[REASONS] if name in features]
    if faults:
        raise ValueError(f"invalid values for prediction: {faults}")
    return float(predict(model, checked).first().prediction)


def response(predicted: DataFrame) -> DataFrame:
    """What the requester gets back: the inputs and the prediction to two decimals."""
    rounded = F.round("prediction", 2).alias("prediccion_unidades_vendidas")
    return predicted.select(*(c for c in predicted.columns if c != "prediction"), rounded)


def score_requests(
    model: PipelineModel, raw: DataFrame, audit_root: str, *, run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Validate, predict and audit a batch; returns responses and rejected requests."""
    checked = check_requests(raw)
    # audit and response both read the predictions; the forest is run once
    predicted = stage(predict(model, valid_requests(checked)), "predicted")
    append_predictions(predicted, audit_root, run_id=run_id)
    return response(predicted), rejected_requests(checked)
