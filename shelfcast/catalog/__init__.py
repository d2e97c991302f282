"""The registered queries over the given tables, each with its expected result in SQL."""

from shelfcast.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    cleaning,
    functions,
    joins,
    layouts,
    models,
    sources_and_sinks,
    windows,
)
from shelfcast.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
