"""Named queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.catalog.fixtures import Fixtures, with_tables
from shelfcast.catalog.sql_parts import PARTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the fixture tables under ``name``; without ``sql`` its result
    is no SQL matter (model training, drawn ids) and only tests look at it."""

    def register(build: Callable[[Fixtures], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Fixtures(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, PARTS)
        return build

    return register
