"""Tables written once to the shared folder and read back by several branches of a plan.

A written table survives the loss of executors, is read column by column, and gives
the planner real sizes. The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Paths written since the start of each open block that will delete them.
_SCOPES: list[list[str]] = []


@cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="shelfcast-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only on a local master, where one machine does
    all the work, a temporary folder stands in for it. A ``file:`` folder is taken as it is:
    whether all machines mount it cannot be seen from here."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _test_folder()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/shelfcast/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back. The files stay, as the
    caller may read the table at any later time; jobs delete them at their end."""
    return _stage(df, new_path(df.sparkSession, name))


def _stage(df: DataFrame, path: str) -> DataFrame:
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, and none outside of it."""
    inside = f"{shared_folder(spark)}/shelfcast"
    if not path.startswith(f"{inside}/"):
        raise ValueError(f"{path} is not a staged table")
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table for the length of a block; its files go at the end."""
    path = new_path(df.sparkSession, name)
    try:
        yield _stage(df, path)
    finally:
        drop_path(df.sparkSession, path)


@contextmanager
def dropping_staged(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is deleted at its end: for jobs, which have written
    their results elsewhere by then. Blocks may nest, but do not run side by side."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            drop_path(spark, path)


def stage_result(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The staged result of ``build``; what was staged on the way to it is deleted."""
    path = new_path(spark, name)
    with dropping_staged(spark):
        result = build()
        result.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return spark.read.schema(result.schema).parquet(path)


def stage_all(**tables: DataFrame) -> list[DataFrame]:
    """Stage several tables at once, so that small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(tables)) as pool:
        waiting = [
            pool.submit(inheritable_thread_target(df.sparkSession)(stage), df, name)
            for name, df in tables.items()
        ]
        return [w.result() for w in waiting]
