"""Scoring requests: validation, required features, model input order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from shelfcast.schemas import FEATURES, REQUEST_SCHEMA, TARGET

REASONS = "motivos"
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def available_features(df: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    """The model features that ``df`` has, in model order."""
    return [c for c in features if c in df.columns]


def select_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The available features and the target; without a target there is nothing to learn."""
    if TARGET not in df.columns:
        raise ValueError(f"target column '{TARGET}' is not in the dataset")
    return df.select(*available_features(df, features), TARGET)


def model_input(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Exactly the model features in model order; missing ones are listed in the error."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for prediction: {missing}")
    return df.select(*features)


def _read(field: Column) -> Column:
    """The text of a field without spaces around it, and what a cast makes of it."""
    plain = F.trim(field["text"])
    return F.struct(
        field["name"].alias("name"),
        field["whole"].alias("whole"),
        plain.alias("plain"),
        plain.try_cast("double").alias("value"),
    )


def _judged(field: Column) -> Column:
    """The value of a field that is a plain finite number, and whole where it has to be; NULL for
    anything else. NaN, infinities and spellings such as 10f or 0x1p3 would stop the model or
    the batch. Of what a cast reads, plain spellings are those without an x that begin with no
    control character and end with a digit or a point: cheaper to see than by a pattern."""
    plain, value = field["plain"], field["value"]
    finite = F.abs(value) < float("inf")  # NaN is larger than infinity
    spelled = (F.ascii(plain) > 32) & F.right(plain, F.lit(1)).isin(*"0123456789.")
    hexadecimal = plain.contains("x") | plain.contains("X")
    fits = ~field["whole"] | ((value == F.floor(value)) & value.between(_INT_MIN, _INT_MAX))
    return F.struct(
        field["name"].alias("name"),
        F.when(finite & spelled & ~hexadecimal & fits, value).alias("value"),
    )


def check_requests(raw: DataFrame) -> DataFrame:
    """Requests with every field typed (NULL where invalid) and the list of invalid fields.
    A field that is missing altogether is invalid in every row.

    The fields go through one loop over an array. As expressions of their own the checks of 15
    fields make a method too long to be compiled, and a filter on the verdict repeats them."""
    fields = []
    for name in FEATURES:
        text = F.col(name).cast("string") if name in raw.columns else F.lit(None).cast("string")
        whole = isinstance(REQUEST_SCHEMA[name].dataType, IntegerType)
        fields.append(
            F.struct(F.lit(name).alias("name"), F.lit(whole).alias("whole"), text.alias("text"))
        )
    judged = F.transform(F.transform(F.array(*fields), _read), _judged)
    extra = [c for c in raw.columns if c not in FEATURES]
    # an exploded array of one is computed once, whatever filters on it
    rows = raw.select(*extra, F.explode(F.array(judged)).alias("_fields"))
    values = [
        F.get("_fields", F.lit(i))["value"].cast(REQUEST_SCHEMA[name].dataType).alias(name)
        for i, name in enumerate(FEATURES)
    ]
    faults = F.transform(
        F.filter("_fields", lambda f: f["value"].isNull()), lambda f: f["name"]
    )
    return rows.select(*extra, *values, faults.alias(REASONS))


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)
