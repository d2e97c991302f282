"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a shuffle of the links; the table of each round is written to the shared folder,
which also cuts the lineage. The number of rounds grows with the logarithm of the longest
chain. Nothing but one count and one checksum per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.sources.staging import stage


def _smallest_neighbours(edges: DataFrame) -> DataFrame:
    """Node and smallest neighbour, as a table of its own: a join with the aggregate itself
    would tie the links of a node to one task, with the table Spark can split them."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = _smallest_neighbours(both).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger node u to the smaller node v."""
    smallest = _smallest_neighbours(edges)
    moved = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (id, component) for every node of ``links``: the smallest node it can reach. Links
    may repeat and point either way; a link of a node with itself or with null is none."""
    edges = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = stage(edges, "cc-links")
    mark = _mark(edges)
    while mark[0]:
        large = stage(_large_star(edges).where("u <> v").distinct(), "cc-large")
        edges = stage(_small_star(large).where("u <> v").distinct(), "cc-small")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
