from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import staging


def there(df):
    return Path(df.inputFiles()[0].removeprefix("file://")).exists()


def test_blocks_nest(spark):
    with staging.dropping_staged(spark):
        outer = staging.stage(spark.range(3), "outer")
        with staging.dropping_staged(spark):
            inner = staging.stage(spark.range(3), "inner")
            inner_file = Path(inner.inputFiles()[0].removeprefix("file://"))
        assert not inner_file.exists() and there(outer)
        outer_file = Path(outer.inputFiles()[0].removeprefix("file://"))
    assert not outer_file.exists()


def test_a_staged_result_leaves_nothing_else(spark):
    passing = []

    def build():
        table = staging.stage(spark.range(5), "passing")
        passing.append(Path(table.inputFiles()[0].removeprefix("file://")))
        return table.withColumn("x", F.col("id") * 2)

    result = staging.stage_result(spark, build, "result")
    assert not passing[0].exists()
    assert sorted(r.x for r in result.collect()) == [0, 2, 4, 6, 8]


def test_a_failing_block_deletes_too(spark):
    passing = []
    with pytest.raises(ZeroDivisionError), staging.dropping_staged(spark):
        table = staging.stage(spark.range(5), "passing")
        passing.append(Path(table.inputFiles()[0].removeprefix("file://")))
        raise ZeroDivisionError
    assert not passing[0].exists()
