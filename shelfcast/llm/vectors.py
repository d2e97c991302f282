"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by rounds of random signs and the fast Hadamard transform; its hash is the
largest coordinate with its sign. Several rotations make a bucket key, several keys the tables.
Every vector lies in one home bucket per table and is looked up in the home buckets of its
most likely neighbours too (multiprobe); candidate pairs are verified by their cosine.

Groups of close vectors are not expanded into pairs. Equal vectors are one class. Vectors
within half the linking angle of the smallest id of a bucket form a ball around it: by the
triangle inequality all of a ball are linked. Candidates are pairs of balls; radii and the
angle of the centres tell whether all their vectors are linked or none are, and only the
pairs in between are verified vector by vector: where the balls are large, in blocks whose tasks
return a count per vector, not the links. Link counts are sums of sizes.

The number of rotations follows the number of distinct vectors, so that chance collisions per
vector stay bounded; the number of tables follows that of the rotations, to keep the recall.

Semantics: a vector that is null, empty, zero, or holds null or non-finite components has no
links. Vectors of different length are never linked. Ids are taken to be unique; rows repeated
as a whole are copies like any others, linked to each other. Other columns are not looked at.

With 10 tables of 3 rotations and 8 probes, or 24 of 4 and 16, vectors of 64 components at
cosine 0.9 are found with probability above 0.98, closer ones nearly always; see the recall test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from shelfcast.llm.common import lean
from shelfcast.llm.components import components
from shelfcast.llm.mtree import matrices
from shelfcast.sources.staging import stage

# Documented parameters.
TABLES, ROTATIONS = 10, 3
NEAREST, PROBES = 3, 8
# A further rotation multiplies the tables and the probes by these; buckets per distinct vector.
MORE_TABLES, MORE_PROBES, SPARSE = 2.4, 2, 32
SEED = 5
# Pairs of vectors that a pair of balls may hold to be expanded; vectors of a block beyond that.
FEW_PAIRS, BLOCK = 1_024, 1_024
# Lengths of vectors whose numbers are looked at to choose their tables.
LENGTHS = 100
# Angles are sums of rounded numbers; what lies this close to a bound is verified in full.
SLACK = 1e-6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n = x.shape[1]
    step = 1
    while step < n:
        halves = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack(
            [halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2
        ).reshape(len(x), n)
        step *= 2
    return x / math.sqrt(n)


def rotate(x: np.ndarray, seed: tuple[int, ...]) -> np.ndarray:
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


def table_shape(vectors: int, width: int) -> tuple[int, int, int]:
    """Tables, rotations and probes for so many distinct vectors of a length: as many rotations
    as leave SPARSE buckets of a table for each."""
    sides = 2 << max(1, (max(width, 1) - 1).bit_length())
    rotations = ROTATIONS
    while sides**rotations < SPARSE * vectors:
        rotations += 1
    more = rotations - ROTATIONS
    return round(TABLES * MORE_TABLES**more), rotations, PROBES * MORE_PROBES**more


def bucket_keys(
    units: np.ndarray, tables: int = TABLES, rotations: int = ROTATIONS, probe_count: int = PROBES
) -> tuple[np.ndarray, np.ndarray]:
    """Home keys (one per table) and probe keys (``probe_count`` per table, the home first)."""
    width = 1 << max(1, (units.shape[1] - 1).bit_length())
    padded = np.zeros((len(units), width))
    padded[:, : units.shape[1]] = units
    near = min(NEAREST, width)
    grid = np.stack(np.meshgrid(*[np.arange(near)] * rotations, indexing="ij"), -1)
    grid = grid.reshape(-1, rotations)
    homes, probes = [], []
    for table in range(tables):
        codes, losses = [], []
        for r in range(rotations):
            turned = rotate(padded, (SEED, width, table, r))
            size = np.abs(turned)
            top = np.argpartition(-size, near - 1, axis=1)[:, :near]
            order = np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable")
            top = np.take_along_axis(top, order, 1)
            at = np.take_along_axis(turned, top, 1)
            codes.append(2 * top + (at > 0))
            losses.append(np.abs(at[:, :1]) - np.abs(at))
        loss = sum(losses[r][:, grid[:, r]] for r in range(rotations))
        best = np.argsort(loss, axis=1, kind="stable")[:, :probe_count]
        key = np.full(best.shape, table + tables * units.shape[1], np.uint64)
        for r in range(rotations):
            chosen = np.take_along_axis(codes[r], grid[best, r], 1).astype(np.uint64)
            key = (key ^ chosen) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
        homes.append(key[:, 0])
        probes.append(key)
    return np.stack(homes, 1).view(np.int64), np.concatenate(probes, 1).view(np.int64)


def unit_vectors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that can have links, and those rows at length 1."""
    with np.errstate(invalid="ignore"):
        good = np.flatnonzero(np.isfinite(x).all(axis=1) & x.any(axis=1))
    x = x[good]
    x = x / np.abs(x).max(axis=1, initial=0.0)[:, None]  # squares of tiny or huge numbers
    return good, x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed: list = [None] * batch.num_rows
        for rows, x in matrices(batch.column("vector")):
            good, units = unit_vectors(x)
            for i, unit in zip(rows[good].tolist(), units, strict=True):
                packed[i] = unit.tobytes()
        digests = [None if u is None else xxhash.xxh3_128_digest(u) for u in packed]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(digests, pa.binary())],
            names=["vec_id", "unit", "digest"],
        )


def _matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def _hash_batches(shapes: dict[int, tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("unit").to_pylist()
            homes: list = [None] * len(packed)
            probes: list = [None] * len(packed)
            lengths = np.fromiter(map(len, packed), np.int64, len(packed))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                shape = shapes.get(int(length), (TABLES, ROTATIONS, PROBES))
                home, probe = bucket_keys(_matrix([packed[i] for i in rows]), *shape)
                for i, h, p in zip(rows.tolist(), home, probe, strict=True):
                    homes[i], probes[i] = h, p
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(homes, pa.list_(pa.int64())),
                    pa.array(probes, pa.list_(pa.int64())),
                ],
                names=[*batch.schema.names, "homes", "probes"],
            )

    return lean(run)


@F.pandas_udf(DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = a.tolist(), b.tolist()
    lengths = np.fromiter(map(len, left), np.int64, len(left))
    same = lengths == np.fromiter(map(len, right), np.int64, len(right))
    found = np.full(len(left), -1.0)  # vectors of different length are never linked
    for length in np.unique(lengths[same]):
        rows = np.flatnonzero(same & (lengths == length))
        x, y = _matrix([left[i] for i in rows]), _matrix([right[i] for i in rows])
        found[rows] = np.einsum("ij,ij->i", x, y)
    return pd.Series(found)


def _with_cosine(pairs: DataFrame, units: DataFrame, a: str, b: str) -> DataFrame:
    left = units.select(F.col("rep").alias(a), F.col("unit").alias("_ua"))
    right = units.select(F.col("rep").alias(b), F.col("unit").alias("_ub"))
    joined = pairs.join(left, a).join(right, b)
    return joined.withColumn("cosine", _cosine("_ua", "_ub")).drop("_ua", "_ub")


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.9,
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows at ``cosine`` or closer),
    component_id (smallest id reachable over links) and kept (vec_id = component_id)."""
    hashed = stage(
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(vector).cast("array<double>").alias("vector"),
        ).mapInArrow(lean(_unit_batches), "vec_id long, unit binary, digest binary"),
        "vectors",
    )
    classes = stage(
        hashed.where("digest IS NOT NULL AND vec_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    distinct = (
        hashed.join(classes, (hashed.digest == classes.digest) & (hashed.vec_id == classes.rep))
        .select("rep", "copies", "unit")
        .dropDuplicates(["rep"])
    )
    distinct = stage(distinct, "vector-distinct")
    # the lengths that most vectors have; others keep the smallest tables
    counted = distinct.groupBy(F.octet_length("unit").alias("bytes")).count()
    shapes = {
        r["bytes"]: table_shape(r["count"], r["bytes"] // 8)
        for r in counted.orderBy(F.desc("count")).limit(LENGTHS).collect()
    }
    reps = stage(
        distinct.mapInArrow(
            _hash_batches(shapes),
            "rep long, copies long, unit binary, homes array<long>, probes array<long>",
        ),
        "vector-reps",
    )
    units = reps.select("rep", "unit")
    homes = stage(reps.select("rep", F.explode("homes").alias("key")), "vector-homes")
    probes = stage(reps.select("rep", F.explode("probes").alias("key")), "vector-probes")

    balls = _balls(reps, units, homes, probes, cosine)
    sized = stage(
        balls.groupBy("ball").agg(
            F.sum("copies").alias("weight"),
            F.count(F.lit(1)).alias("members"),
            F.max("angle").alias("radius"),
        ),
        "vector-balls",
    )
    inside = balls.select("rep", "ball")
    pairs = _ball_pairs(
        homes.join(inside, "rep").select("key", "ball").distinct(),
        probes.join(inside, "rep").select("key", "ball").distinct(),
    )

    def of(name: str) -> DataFrame:
        return sized.select(
            F.col("ball").alias(name),
            F.col("weight").alias(f"weight_{name}"),
            F.col("members").alias(f"members_{name}"),
            F.col("radius").alias(f"radius_{name}"),
        )

    limit = math.acos(cosine)
    angle = F.acos(F.least(F.greatest("cosine", F.lit(-1.0)), F.lit(1.0)))
    spread = F.col("radius_a") + F.col("radius_b")
    both_single = (F.col("members_a") == 1) & (F.col("members_b") == 1)
    compared = stage(
        _with_cosine(pairs, units, "a", "b")
        .join(of("a"), "a")
        .join(of("b"), "b")
        .withColumn(
            "all",
            F.when(both_single, F.col("cosine") >= cosine).otherwise(
                angle + spread <= limit - SLACK
            ),
        )
        .withColumn("some", ~F.col("all") & ~both_single & (angle - spread <= limit + SLACK)),
        "vector-ball-pairs",
    )
    whole = compared.where("all")
    single, links = _member_links(
        compared.where("some").select("a", "b", "members_a", "members_b"),
        balls.select("rep", "copies", "ball"),
        units,
        cosine,
    )
    of_balls = (
        whole.select(F.col("a").alias("ball"), F.col("weight_b").alias("n"))
        .unionByName(whole.select(F.col("b").alias("ball"), F.col("weight_a").alias("n")))
        .groupBy("ball")
        .agg(F.sum("n").alias("_whole"))
    )
    of_reps = single.groupBy("rep").agg(F.sum("n").alias("_single"))
    reached = components(whole.select("a", "b").unionByName(links))
    zero = F.lit(0)
    per_rep = stage(
        balls.join(sized.select("ball", "weight"), "ball")
        .join(of_balls, "ball", "left")
        .join(of_reps, "rep", "left")
        .join(reached.withColumnRenamed("id", "ball"), "ball", "left")
        .select(
            "rep",
            (
                F.col("weight") - 1 + F.coalesce("_whole", zero) + F.coalesce("_single", zero)
            ).alias("n_links"),
            F.coalesce("component", "ball").alias("component"),
        ),
        "vector-results",
    )
    result = (
        hashed.select("vec_id", "digest")
        .join(classes.select("digest", "rep"), "digest", "left")
        .join(per_rep, "rep", "left")
    )
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", zero).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _balls(
    reps: DataFrame, units: DataFrame, homes: DataFrame, probes: DataFrame, cosine: float
) -> DataFrame:
    """Rows (rep, copies, ball, angle): the ball is named by its centre, its smallest id.
    A centre is in no other ball; a vector near several centres takes the smallest."""
    half = math.cos(math.acos(cosine) / 2 - SLACK)
    heads = stage(homes.groupBy("key").agg(F.min("rep").alias("head")), "vector-heads")
    near = stage(
        _with_cosine(
            probes.join(heads, "key").where("head < rep").select("rep", "head").distinct(),
            units,
            "rep",
            "head",
        ).where(F.col("cosine") >= half),
        "vector-near",
    )
    taken = stage(near.select(F.col("rep").alias("head")).distinct(), "vector-taken")
    chosen = (
        near.join(taken, "head", "left_anti")
        .groupBy("rep")
        .agg(F.min(F.struct("head", "cosine")).alias("_c"))
    )
    angle = F.acos(F.least("_c.cosine", F.lit(1.0)))
    return stage(
        reps.select("rep", "copies")
        .join(chosen, "rep", "left")
        .select(
            "rep",
            "copies",
            F.coalesce("_c.head", "rep").alias("ball"),
            F.coalesce(angle, F.lit(0.0)).alias("angle"),
        ),
        "vector-members",
    )


def _member_links(
    pairs: DataFrame, members: DataFrame, units: DataFrame, cosine: float
) -> tuple[DataFrame, DataFrame]:
    """Of members (rep, copies, ball) of the balls paired in ``pairs`` (a, b, members_a,
    members_b): rows (rep, n) that add up to the linked vectors of the other balls, and links
    (a, b) of balls that have any.

    Pairs of few members are expanded. Of others both sides are cut into blocks, and every two
    blocks are compared in a task of their own, which returns one row per member."""
    expanded = F.col("members_a") * F.col("members_b") <= FEW_PAIRS

    def side(name: str, member: str, count: str) -> DataFrame:
        return members.select(
            F.col("ball").alias(name), F.col("rep").alias(member), F.col("copies").alias(count)
        )

    few = (
        pairs.where(expanded)
        .select("a", "b")
        .join(side("a", "x", "nx"), "a")
        .join(side("b", "y", "ny"), "b")
    )
    linked = stage(
        _with_cosine(few, units, "x", "y").where(F.col("cosine") >= cosine).drop("cosine"),
        "vector-links",
    )

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / BLOCK)

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), blocks(count) - 1))

    tasks = (
        pairs.where(~expanded).withColumn("i", numbers("members_a")).withColumn("j", numbers("members_b"))
    )
    # the block of a member of a large ball
    sizes = members.groupBy("ball").agg(F.count(F.lit(1)).alias("_n"))
    dealt = members.join(sizes.where(F.col("_n") > 1), "ball").withColumn(
        "block", F.pmod(F.xxhash64("rep"), blocks("_n"))
    )
    alone = members.join(sizes.where(F.col("_n") == 1), "ball").withColumn(
        "block", F.lit(0).cast("long")
    )
    placed = dealt.unionByName(alone).select("ball", "block", "rep", "copies").join(units, "rep")

    def rows(ball: str, block: str, number: int) -> DataFrame:
        named = placed.withColumnsRenamed({"ball": ball, "block": block})
        return tasks.select("a", "b", "i", "j").join(named, [ball, block]).select(
            "a", "b", "i", "j", F.lit(number).alias("side"), "rep", "copies", "unit"
        )

    both = rows("a", "i", 0).unionByName(rows("b", "j", 1))
    counted = stage(
        both.groupBy("a", "b", "i", "j").applyInPandas(
            _block_links(cosine), "a long, b long, rep long, n long"
        ),
        "vector-block-links",
    )
    single = (
        linked.select(F.col("x").alias("rep"), F.col("ny").alias("n"))
        .unionByName(linked.select(F.col("y").alias("rep"), F.col("nx").alias("n")))
        .unionByName(counted.select("rep", "n"))
    )
    # all of a ball is one component, so that any link joins the whole balls
    links = linked.select("a", "b").unionByName(counted.select("a", "b")).distinct()
    return single, links


def _block_links(cosine: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        found = []
        for length in set(a["unit"].map(len)) & set(b["unit"].map(len)):
            x, y = (part[part["unit"].map(len) == length] for part in (a, b))
            linked = _matrix(x["unit"].tolist()) @ _matrix(y["unit"].tolist()).T >= cosine
            for part, counts in (
                (x, linked @ y["copies"].to_numpy()),
                (y, linked.T @ x["copies"].to_numpy()),
            ):
                some = counts > 0
                found += zip(part["rep"][some], counts[some], strict=True)
        return pd.DataFrame(
            [(key[0], key[1], rep, n) for rep, n in found], columns=["a", "b", "rep", "n"]
        ).astype("int64")

    return run


def _ball_pairs(homes: DataFrame, probes: DataFrame) -> DataFrame:
    """Distinct pairs a < b of balls of which one looks into a home bucket of the other."""
    homes = stage(homes.withColumnRenamed("ball", "_home"), "vector-ball-homes")
    probes = stage(probes, "vector-ball-probes")
    return (
        probes.join(homes, "key")
        .where("ball <> _home")
        .select(F.least("ball", "_home").alias("a"), F.greatest("ball", "_home").alias("b"))
        .distinct()
    )
