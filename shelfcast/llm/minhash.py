r"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct shingles of ``n`` words (lower-cased A-Z). Equal sets
are one class from the start, so exact copies are never compared. Of each class the minima
under many hash functions are taken: bands of them give candidates, and of every minimum only
the lowest four bits are kept, packed into longs. Equal four-bit groups are counted with XOR
and a bit count, corrected for chance collisions, and weed out unlikely candidates. What is
left is confirmed on the full sets.

Candidates are not expanded into all pairs of a bucket. Each class is first compared with the
smallest class it shares most buckets with; what is linked to it forms a ball around it, with
the distance of each member known. Then balls that share a bucket are compared by their
centres. Jaccard distance is a metric, so centre distance and member distances tell which
balls hold members that could be linked at all: only those are compared, in blocks, and only
where the balls are not in one component already.

Semantics: a text with fewer words than a shingle is one shingle; a null text or one without
words has the empty set and is linked with nothing. Ids are taken to be unique; rows repeated
as a whole are copies like any others, and each of them gets the result of its text. A null id
forms no links. Other columns are not looked at.

With 40 bands of 6 minima a pair of similarity 0.8 shares no band with probability 5e-6. The
four-bit estimate has a standard error of about 0.03; pairs within 0.14 of the threshold pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from shelfcast.llm.common import lean, slices
from shelfcast.llm.components import components
from shelfcast.sources.staging import stage

# Documented parameters.
BANDS, ROWS = 40, 6
BITS = 4
MARGIN = 0.14
CLIMBS = 3
PERCENT = 80
KNOWN_WORDS = 100_000
# Distances are rounded quotients; bounds on them leave this much room.
SLACK = 1e-9
BLOCK = 2_048
# Balls of a bucket that are paired by a join, balls and shingles in a block beyond that.
FEW_BALLS, BLOCK_BALLS, BLOCK_SHINGLES = 32, 256, 1 << 16
MATRIX_COLUMNS = 8_192

_PER_LONG = 64 // BITS


class _Words(dict):
    """Digests of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        digest = self[word] = xxhash.xxh3_64_intdigest(word)
        return digest


def shingles(text: bytes, n: int, known: _Words) -> np.ndarray:
    """Sorted distinct digests of the shingles of a text; empty without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digests = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    # a shorter text has another start value, so it never equals a full shingle
    hashed = np.full(len(words) - width + 1, 0x9E3779B97F4A7C15 * width % 2**64, np.uint64)
    for i in range(width):
        hashed ^= digests[i : len(digests) - width + 1 + i]
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
    return np.unique(hashed)


def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2**63, count, dtype=np.uint64) * 2 + 1


def minima(shingle_set: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each function."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_set), BLOCK):
        hashed = multipliers[:, None] * shingle_set[None, at : at + BLOCK]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def _pack(least: np.ndarray) -> np.ndarray:
    """Four bits of each minimum, sixteen to a long. Low bits of a product are weak, so the
    minima are mixed first."""
    mixed = (least ^ (least >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    low = (mixed >> np.uint64(64 - BITS)).reshape(-1, _PER_LONG)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=1).view(np.int64)


def _band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    keys = np.arange(len(least) // rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        keys ^= least[i::rows]
        keys *= np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def _features(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, multipliers = _Words(), _multipliers(bands * rows)
        for batch in slices(batches):
            counts, digests, keys, packed = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text or b"", n, known)
                counts.append(len(found))
                if not len(found):
                    digests.append(None), keys.append(None), packed.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                least = minima(found, multipliers)
                keys.append(_band_keys(least, rows))
                packed.append(_pack(least))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(packed, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "keys", "packed"],
            )

    return lean(run)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sets = [shingles(text or b"", n, known).tobytes() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"]
            )

    return lean(run)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs without their sets, with the number of shingles in both."""
    for batch in slices(batches, "shingles_a"):
        counts = []
        for a, b in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
            left = np.frombuffer(a.as_buffer(), np.uint64)
            right = np.frombuffer(b.as_buffer(), np.uint64)
            counts.append(len(np.intersect1d(left, right, assume_unique=True)))
        kept = [n for n in batch.schema.names if not n.startswith("shingles_")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(counts, pa.int64())],
            names=[*kept, "shared"],
        )


def estimate(a: Column, b: Column, minima_count: int) -> Column:
    """Similarity from packed signatures: groups of four bits that are equal, less those that
    are equal by chance."""
    low = F.lit(0x1111111111111111)

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        any_bit = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(any_bit, 2))
        return F.bit_count(any_bit.bitwiseAND(low))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, d: n + d)
    chance = 1 / (1 << BITS)
    return (1 - unequal / F.lit(minima_count) - chance) / (1 - chance)


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable over
    links of at least ``percent`` similarity) and kept (doc_id = component_id)."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    features = stage(
        named.mapInArrow(
            _features(n, bands, rows),
            "doc_id long, n_shingles long, digest binary, keys array<long>, packed array<long>",
        ),
        "minhash",
    )
    # one class per distinct set, named by its smallest id
    classes = stage(
        features.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep")),
        "minhash-classes",
    )
    by_class = features.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    leaders = stage(
        features.join(
            classes, (features.digest == classes.digest) & (features.doc_id == classes.rep)
        )
        .select("rep", classes.digest, "n_shingles", "keys", "packed")
        .dropDuplicates(["digest"]),
        "minhash-leaders",
    )
    buckets = stage(_shared_buckets(leaders.select("rep", F.explode("keys").alias("key"))), "minhash-buckets")
    compared = stage(buckets.select("rep").distinct(), "minhash-compared")
    # the sets of classes that share a bucket with another class, once
    wanted = named.join(compared.withColumnRenamed("rep", "doc_id"), "doc_id")
    sets = stage(
        wanted.mapInArrow(_sets(n), "doc_id long, shingles binary")
        .withColumn("size", F.expr("octet_length(shingles) div 8"))
        .withColumn("digest", F.xxhash64("shingles"))
        .dropDuplicates(["doc_id", "digest"])
        .drop("digest"),
        "minhash-sets",
    )
    signatures = leaders.select("rep", "packed")

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose estimate comes near the threshold."""
        signed = pairs.join(_as(signatures, "a", "packed"), "a").join(
            _as(signatures, "b", "packed"), "b"
        )
        similarity = estimate(F.col("packed_a"), F.col("packed_b"), bands * rows)
        return signed.where(similarity >= percent / 100 - MARGIN).select(*pairs.columns)

    def measured(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs with their distance on the full sets and whether they are links."""
        full = pairs.join(_as(sets, "a", "shingles", "size", key="doc_id"), "a").join(
            _as(sets, "b", "shingles", "size", key="doc_id"), "b"
        )
        kept = full.drop("shingles_a", "shingles_b").schema
        shared = full.mapInArrow(lean(_shared), StructType(kept.fields).add("shared", LongType()))
        union = F.col("size_a") + F.col("size_b") - F.col("shared")
        return stage(
            shared.select(
                *pairs.columns,
                (1 - F.col("shared") / union).alias("distance"),
                (F.col("shared") * 100 >= percent * union).alias("linked"),
            ),
            name,
        )

    balls, links = _balls(buckets, lambda pairs: measured(likely(pairs), "minhash-near"))
    component = components(links)
    balls = stage(
        balls.join(component.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        ),
        "minhash-balls",
    )
    radii = stage(
        balls.groupBy("ball").agg(F.max("distance").alias("radius")), "minhash-radii"
    )
    least = percent / 100 - MARGIN
    about = signatures.withColumnRenamed("rep", "ball").join(radii, "ball")
    pairs = stage(_ball_pairs(buckets, balls, about, least, bands * rows), "minhash-pairs")
    pairs = pairs.join(
        radii.select(F.col("ball").alias("a"), F.col("radius").alias("radius_a")), "a"
    ).join(radii.select(F.col("ball").alias("b"), F.col("radius").alias("radius_b")), "b")
    centres = measured(pairs, "minhash-centres")
    room = F.col("radius_a") + F.col("radius_b")
    more = centres.where("linked").select("a", "b")
    links = links.unionByName(more)
    component = components(links)

    # members of unlinked balls that the distances do not rule out
    limit = 1 - percent / 100 + SLACK
    open_pairs = (
        centres.where(~F.col("linked") & (F.col("distance") <= limit + room))
        .join(component.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(component.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
        .select("a", "b")
    )
    members = balls.select("rep", "ball").join(
        component.withColumnRenamed("id", "rep"), "rep", "left"
    )
    members = stage(
        members.withColumn("component", F.coalesce("component", "rep")), "minhash-inner"
    )
    last = _member_links(stage(open_pairs, "minhash-open"), members, sets, percent)
    component = components(links.unionByName(last))

    result = by_class.withColumn("_node", F.coalesce("rep", "doc_id"))
    result = result.join(
        component.select(F.col("id").alias("_node"), F.col("component")), "_node", "left"
    )
    reached = F.coalesce("component", "_node")
    return result.select(
        "doc_id",
        "n_shingles",
        reached.alias("component_id"),
        F.coalesce(F.col("doc_id") == reached, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, found: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``found`` (the result of ``near_duplicates``) keeps, one of
    each set of repeated rows."""
    gone = stage(found.where("NOT kept").select("doc_id").distinct(), "minhash-gone")
    repeated = stage(
        found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"),
        "minhash-repeated",
    )
    kept = docs.join(gone, docs[doc_id] == gone["doc_id"], "left_anti")
    same = docs[doc_id].eqNullSafe(repeated["doc_id"])
    once = kept.join(repeated, same, "left_anti")
    again = kept.join(repeated, same, "left_semi")
    return once.unionByName(again.dropDuplicates())


def _as(table: DataFrame, name: str, *columns: str, key: str = "rep") -> DataFrame:
    return table.select(F.col(key).alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def _shared_buckets(members: DataFrame) -> DataFrame:
    """The rows (rep, key) of buckets with at least two classes."""
    members = stage(members, "minhash-bands")
    several = members.groupBy("key").agg(
        F.min("rep").alias("first"), F.max("rep").alias("last")
    )
    several = stage(several.where("first <> last").select("key"), "minhash-several")
    return members.join(several, "key")


def _balls(
    buckets: DataFrame, measure: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Rows (rep, ball, distance) and the links found on the way. The ball is named by its
    centre, which is in no other ball. A class whose head has a head itself moves up to that
    one if it is linked with it, else it stays a ball of its own."""
    heads = stage(buckets.groupBy("key").agg(F.min("rep").alias("head")), "minhash-heads")
    pairs = (
        buckets.join(heads, "key")
        .where("head < rep")
        .groupBy("rep", "head")
        .count()
        .groupBy("rep")
        .agg(F.max_by("head", F.struct("count", -F.col("head"))).alias("head"))
        .select(F.col("head").alias("a"), F.col("rep").alias("b"))
    )
    near = measure(pairs).where("linked").select("a", "b", "distance")
    links, assigned = near.select("a", "b"), near
    for _ in range(CLIMBS):
        upper = assigned.select(F.col("b").alias("a"), F.col("a").alias("top"))
        moving = assigned.join(upper, "a").select(F.col("top").alias("a"), "b")
        moving = stage(moving, "minhash-moving")
        if moving.isEmpty():
            break
        moved = measure(moving).where("linked").select("a", "b", "distance")
        settled = assigned.join(moving.select("b"), "b", "left_anti")
        links = links.unionByName(moved.select("a", "b"))
        assigned = stage(settled.select("a", "b", "distance").unionByName(moved), "minhash-moved")
    under = assigned.select(F.col("b").alias("a")).distinct()
    assigned = assigned.join(under, "a", "left_anti")
    every = buckets.select("rep").distinct()
    balls = every.join(assigned.withColumnRenamed("b", "rep"), "rep", "left").select(
        "rep",
        F.coalesce("a", "rep").alias("ball"),
        F.coalesce("distance", F.lit(0.0)).alias("distance"),
    )
    return balls, links


def _ball_pairs(
    buckets: DataFrame, balls: DataFrame, about: DataFrame, least: float, minima_count: int
) -> DataFrame:
    """Distinct pairs a < b of balls of different components that share a bucket and whose
    estimate, with the radii (``about``: ball, packed, radius) added, reaches ``least``.

    A bucket of few balls is joined with itself: that makes at most FEW_BALLS pairs per entry.
    The balls of a larger one are cut into blocks, and blocks are compared in tasks of two
    blocks each, which return likely pairs alone."""
    inside = buckets.join(balls.select("rep", "ball", "component"), "rep")
    entries = stage(inside.select("key", "ball", "component").distinct(), "minhash-entries")
    several = entries.groupBy("key").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count(F.lit(1)).alias("n"),
    )
    several = stage(several.where("low <> high").select("key", "n"), "minhash-mixed")
    mixed = stage(
        entries.join(several, "key").join(about, "ball"), "minhash-mixed-entries"
    )
    few = mixed.where(F.col("n") <= FEW_BALLS).drop("n")
    other = few.select(*[F.col(c).alias(f"_{c}") for c in few.columns])
    similarity = estimate(F.col("packed"), F.col("_packed"), minima_count)
    near = (
        few.join(other, F.col("key") == F.col("_key"))
        .where("ball < _ball AND component <> _component")
        .where(similarity + F.col("radius") + F.col("_radius") >= least)
        .select(F.col("ball").alias("a"), F.col("_ball").alias("b"))
    )
    many = mixed.where(F.col("n") > FEW_BALLS).withColumn(
        "_blocks", F.ceil(F.col("n") / BLOCK_BALLS)
    )
    own = F.pmod(F.xxhash64("ball"), F.col("_blocks"))
    blocked = many.withColumn("_own", own).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    tasks = blocked.select(
        "key",
        F.least("_own", "_with").alias("i"),
        F.greatest("_own", "_with").alias("j"),
        "ball",
        "component",
        "packed",
        "radius",
    )
    compared = tasks.groupBy("key", "i", "j").applyInPandas(
        _block_pairs(least, minima_count), "a long, b long"
    )
    return near.unionByName(compared).distinct()


def _block_pairs(least: float, minima_count: int):
    chance = 1 / (1 << BITS)
    low = np.uint64(0x1111111111111111)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ball, component = rows["ball"].to_numpy(), rows["component"].to_numpy()
        radius = rows["radius"].to_numpy()
        packed = np.stack(rows["packed"].to_numpy()).view(np.uint64)
        found = []
        for i in range(len(rows)):
            z = packed[i] ^ packed
            z |= z >> np.uint64(1)
            z |= z >> np.uint64(2)
            unequal = np.bitwise_count(z & low).sum(axis=1)
            similarity = (1 - unequal / minima_count - chance) / (1 - chance)
            likely = similarity + radius + radius[i] >= least
            likely &= (ball > ball[i]) & (component != component[i])
            found += [(ball[i], b) for b in ball[likely]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _member_links(
    pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) between members (rep, ball, component) of the balls paired in ``pairs``.

    The pairs are gathered at their larger ball: its members on one side, those of its
    partners on the other. Both sides are cut into blocks of about BLOCK_SHINGLES, and every
    two blocks are compared in a task of their own, on the full sets. A task returns one link
    per member and component at most, which is what components need."""
    sizes = members.groupBy("ball").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes, "minhash-sizes")

    def of(name: str) -> DataFrame:
        return sizes.select(F.col("ball").alias(name), F.col("n").alias(f"n_{name}"))

    larger = (F.col("n_a") > F.col("n_b")) | (
        (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))
    )
    at = pairs.join(of("a"), "a").join(of("b"), "b").select(
        F.when(larger, F.col("a")).otherwise(F.col("b")).alias("at"),
        F.when(larger, F.col("b")).otherwise(F.col("a")).alias("ball"),
    )
    centres = at.select("at").distinct().select("at", F.col("at").alias("ball"))
    sides = stage(
        centres.withColumn("side", F.lit(0)).unionByName(at.distinct().withColumn("side", F.lit(1))),
        "minhash-sides",
    )
    measured = sets.select(F.col("doc_id").alias("rep"), "size")
    items = stage(sides.join(members, "ball").join(measured, "rep"), "minhash-items")
    weights = items.groupBy("at", "side").agg(F.sum("size").alias("shingles"))
    blocks = stage(
        weights.withColumn("blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES))
        .groupBy("at")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("blocks"))).alias("blocks_0"),
            F.max(F.when(F.col("side") == 1, F.col("blocks"))).alias("blocks_1"),
        ),
        "minhash-blocks",
    )
    first = F.col("side") == 0
    mine = F.when(first, F.col("blocks_0")).otherwise(F.col("blocks_1"))
    theirs = F.when(first, F.col("blocks_1")).otherwise(F.col("blocks_0"))
    own = F.pmod(F.xxhash64("rep"), mine)
    placed = items.join(blocks, "at").withColumn("_own", own).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), theirs - 1))
    )
    tasks = placed.select(
        "at",
        F.when(first, F.col("_own")).otherwise(F.col("_with")).alias("i"),
        F.when(first, F.col("_with")).otherwise(F.col("_own")).alias("j"),
        "side",
        "rep",
        "component",
    )
    shingles_of = sets.select(F.col("doc_id").alias("rep"), "shingles")
    return (
        tasks.join(shingles_of, "rep")
        .groupBy("at", "i", "j")
        .applyInPandas(_block_links(percent), "a long, b long")
    )


def _block_links(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        own = [[np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right)]
        size = [np.array([len(x) for x in side]) for side in own]
        flat = [np.concatenate(side) for side in own]
        row = [np.repeat(np.arange(len(n)), n) for n in size]
        common = np.intersect1d(*flat)
        shared = np.zeros((len(left), len(right)), np.int64)
        for at in range(0, len(common), MATRIX_COLUMNS):
            part = common[at : at + MATRIX_COLUMNS]
            matrix = []
            for side in (0, 1):
                place = np.searchsorted(part, flat[side])
                place[place == len(part)] = 0
                hit = part[place] == flat[side]
                m = np.zeros((len(size[side]), len(part)), np.float32)
                m[row[side][hit], place[hit]] = 1
                matrix.append(m)
            shared += np.rint(matrix[0] @ matrix[1].T).astype(np.int64)
        union = size[0][:, None] + size[1][None, :] - shared
        linked = shared * 100 >= percent * union
        component = [side["component"].to_numpy() for side in (left, right)]
        linked &= component[0][:, None] != component[1][None, :]
        found = {}
        for i, j in zip(*np.nonzero(linked), strict=True):
            # one link of the right member with each component on the left will do
            found.setdefault((j, component[0][i]), (left["rep"].iat[i], right["rep"].iat[j]))
        return pd.DataFrame(list(found.values()), columns=["a", "b"], dtype="int64")

    return run
