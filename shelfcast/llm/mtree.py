"""Exact top-k search by inner product with M-trees.

Components become whole numbers, floor(256 x). One more coordinate, sqrt(M^2 - |v|^2) with M the
longest length, and 0 for a query, turns the largest inner product into the smallest Euclidean
distance: d(q, v)^2 = |q|^2 + M^2 - 2 q.v. That is a metric, so an M-tree can search it.

Vectors are dealt to the nearest of a few pivots, and a pivot's vectors to trees of bounded size.
A tree is a table of pages: inner pages route to pages below, leaf pages hold vectors; each page
keeps its routing vector, covering radius and distance to the routing vector of its parent, each
entry of a leaf its distance to the routing vector. The queries of a block go through a tree
together, best first: a heap of pages by their least possible distance, until that is beyond the
k-th best found. What the stored distances rule out by the triangle inequality for all queries
that look into a page is never computed.

Queries stand in blocks of bounded size. First each searches a tree of its own pivot, which gives
it a k-th best; then its block is matched with the trees that some query of it cannot rule out by
pivot and radius. A task holds one block and one tree. Nothing is dropped: a bound only skips
what cannot be among the best. Scores are whole numbers and compared exactly; bounds are widened
by ``SLACK`` for rounding.

Semantics: a vector that is null, holds a null or non-finite component, has no id, or is so long
that scores would not fit a long (squared length 2^62 or more) takes no part. Only vectors of the
same number of components have a score. Of rows that repeat an id one takes part, that with the
least components. Ties go to the smaller id. A query without candidates has no rows. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import lean, uniform_key
from shelfcast.sources.staging import stage

# Documented parameters: vectors of a tree and a page, pages under a page, queries of a block,
# pivots and the rows they are chosen from.
TREE, PAGE, FANOUT = 8_192, 256, 32
BLOCK = 1_024
PIVOTS, PIVOT_ROWS = 32, 512
SEED = 11
# Share of M by which distances may be off; their rounding is below a tenth of it.
SLACK = 1e-6
# Inner products in double precision are exact below, by the Cauchy-Schwarz inequality.
EXACT = 2.0**52
LONGEST = 2.0**62

TREE_KEY = ("width", "cell", "chunk")


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column and their components, for every length in it."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for width in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == width)
        yield rows, values[offsets[rows][:, None] + np.arange(width)]


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in matrices(batch.column("vector")):
            with np.errstate(over="ignore", invalid="ignore"):
                cells = np.floor(256 * x)
                norms = (cells * cells).sum(axis=1)
            good = np.flatnonzero(np.isfinite(x).all(axis=1) & (norms < LONGEST))
            ints = cells[good].astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows[good])),
                    pa.array(np.full(len(good), x.shape[1]), pa.int32()),
                    pa.array([row.tobytes() for row in ints], pa.binary()),
                    pa.array(norms[good], pa.float64()),
                ],
                names=["vec_id", "width", "vector", "norm"],
            )


def unpacked(vectors: list[bytes] | pd.Series, width: int) -> np.ndarray:
    joined = b"".join(vectors)
    return np.frombuffer(joined, "<i4").reshape(len(vectors), width).astype(np.float64)


def products(x: np.ndarray, y: np.ndarray, norm_x: float, norm_y: float) -> np.ndarray:
    """Exact inner products of rows of x with y (a row or several), as longs."""
    if norm_x * norm_y < EXACT * EXACT:
        return (x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def distances(x: np.ndarray, norms: np.ndarray, y: np.ndarray, norm: float, most: float) -> np.ndarray:
    """Distances of vectors x to a vector y, all with the added coordinate; ``most`` is M^2."""
    more = np.sqrt(np.maximum(most - norms, 0)) * math.sqrt(max(most - norm, 0))
    return np.sqrt(np.maximum(2 * (most - x @ y - more), 0))


@dataclass
class Page:
    """A node: its routing vector, how far its vectors reach from it, how far it is from the
    routing vector of its parent; vectors of a leaf with their distances."""

    routing: np.ndarray
    norm: float
    radius: float
    parent: int
    parent_distance: float
    leaf: bool
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    members: np.ndarray | None = None
    reach: np.ndarray = field(default_factory=lambda: np.zeros(0))


def build(
    ids: np.ndarray,
    x: np.ndarray,
    norms: np.ndarray,
    most: float,
    routing: np.ndarray,
    norm: float,
    *,
    page: int = PAGE,
    fanout: int = FANOUT,
) -> list[Page]:
    """Pages of an M-tree over the rows of x, the root first, parents before their pages."""
    rng, pages = np.random.default_rng(SEED), []
    # rows, their distances to the routing vector, routing vector, its norm, parent, distance
    todo = [(np.arange(len(x)), distances(x, norms, routing, norm, most), routing, norm, -1, 0.0)]
    while todo:
        rows, reach, routing, norm, parent, apart = todo.pop()
        own = Page(routing, norm, float(reach.max(initial=0.0)), parent, apart, len(rows) <= page)
        pages.append(own)
        if own.leaf:
            own.ids, own.members, own.reach = ids[rows], x[rows], reach
            continue
        count = min(fanout, -(-len(rows) // page))
        heads = rng.choice(rows, count, replace=False)
        all_reach = np.stack([distances(x[rows], norms[rows], x[h], norms[h], most) for h in heads])
        nearest = all_reach.argmin(axis=0)
        if (nearest == nearest[0]).all():  # equal vectors: any cut will do
            nearest = np.arange(len(rows)) * count // len(rows)
        for k, head in enumerate(heads):
            part = np.flatnonzero(nearest == k)
            if len(part):
                gap = distances(x[[head]], norms[[head]], routing, norm, most)[0]
                here = len(pages) - 1
                todo.append((rows[part], all_reach[k, part], x[head], norms[head], here, float(gap)))
    return pages


class Tree:
    """Pages as a search reads them: of every inner page its pages below, as arrays."""

    def __init__(self, pages: list[Page], most: float):
        self.pages, self.most = pages, most
        below: dict[int, list[int]] = {}
        for number, page in enumerate(pages):
            below.setdefault(page.parent, []).append(number)
        self.below = {
            parent: (
                np.array(numbers),
                np.stack([pages[n].routing for n in numbers]),
                np.array([pages[n].radius for n in numbers]),
                np.array([pages[n].parent_distance for n in numbers]),
            )
            for parent, numbers in below.items()
        }
        self.largest = max(p.norm for p in pages)
        self.computed = 0

    def search(
        self,
        queries: np.ndarray,
        norms: np.ndarray,
        query_ids: np.ndarray,
        k: int,
        least: np.ndarray | None = None,
    ) -> list[list[tuple[int, int]]]:
        """Per query (a row of ``queries``) the k best (score, id), best first, of those that
        score at least ``least`` (NaN: any).

        The heap holds the pages still to be seen, by the least distance that any query could
        find in them. What a page costs is paid only for the queries it is open for: those
        whose bound for it is within their k-th best distance.
        """
        base, slack = norms + self.most, SLACK * math.sqrt(self.most)
        bounds = np.full(len(queries), np.nan) if least is None else least.astype(np.float64)
        floors = [-math.inf if math.isnan(b) else int(b) for b in bounds.tolist()]
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        root = self.pages[0]

        def apart(scores: np.ndarray, asking: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base[asking, None] - 2 * scores, 0))

        every = np.arange(len(queries))
        reach = np.where(np.isnan(bounds), np.inf, np.sqrt(np.maximum(base - 2 * bounds, 0)) + slack)
        gaps = {0: apart((queries @ root.routing)[:, None], every)[:, 0]}
        heap = [(0.0, 0)]
        while heap:
            nearest, number = heapq.heappop(heap)
            gap, page = gaps.pop(number), self.pages[number]
            if nearest > reach.max():
                break
            asking = np.flatnonzero(gap - page.radius <= reach)
            if not len(asking):
                continue
            gap, far = gap[asking], reach[asking]
            if not page.leaf:
                numbers, routings, radii, between = self.below[number]
                possible = np.abs(gap[:, None] - between) - radii <= far[:, None]
                open_ = np.flatnonzero(possible.any(axis=0))
                self.computed += len(open_) * len(asking)
                there = apart(queries[asking] @ routings[open_].T, asking)
                for at, n in enumerate(numbers[open_].tolist()):
                    mine = np.where(possible[:, open_[at]], there[:, at], np.inf)
                    bound = float((mine - radii[open_[at]]).min())
                    if bound < np.inf:
                        gaps[n] = np.full(len(queries), np.inf)
                        gaps[n][asking] = mine
                        heapq.heappush(heap, (max(bound, 0.0), n))
                continue
            near = np.abs(gap[:, None] - page.reach) <= far[:, None]
            near &= page.ids != query_ids[asking, None]
            entries = np.flatnonzero(near.any(axis=0))
            self.computed += len(entries) * len(asking)
            if not len(entries):
                continue
            whole = len(entries) == len(page.ids)
            members = page.members if whole else page.members[entries]
            scores = products(queries[asking], members, self.most, float(norms[asking].max()))
            limits = [best[q][-1][0] if len(best[q]) == k else floors[q] for q in asking.tolist()]
            good = scores >= np.array(limits, np.float64)[:, None] - 1  # compared exactly below
            good &= near if whole else near[:, entries]
            for at in np.flatnonzero(good.any(axis=1)).tolist():
                q, found = int(asking[at]), np.flatnonzero(good[at])
                own = scores[at, found]
                if len(found) > k:
                    kept = own >= np.partition(own, -k)[-k]
                    found, own = found[kept], own[kept]
                ids = page.ids[entries[found]].tolist()
                added = [(-s, i) for s, i in zip(own.tolist(), ids, strict=True) if s >= floors[q]]
                merged = heapq.nsmallest(k, [*added, *((-s, i) for s, i in best[q])])
                best[q] = [(-s, i) for s, i in merged]
                if len(best[q]) == k:
                    bound = max(best[q][-1][0], floors[q])
                    reach[q] = math.sqrt(max(base[q] - 2 * float(bound), 0)) + slack
        return best


@dataclass(frozen=True)
class Cells:
    """Pivots by number of components, and M^2. A length without pivots has one cell, -1."""

    pivots: dict[int, np.ndarray]
    most: float

    def nearest(self, x: np.ndarray, norms: np.ndarray) -> np.ndarray:
        pivots = self.pivots.get(x.shape[1])
        if pivots is None or not len(pivots):
            return np.full(len(x), -1)
        sizes = (pivots * pivots).sum(axis=1)
        return np.stack(
            [distances(x, norms, p, n, self.most) for p, n in zip(pivots, sizes, strict=True)]
        ).argmin(axis=0)


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    widths = batch.column("width").to_numpy()
    vectors, norms = batch.column("vector"), batch.column("norm").to_numpy()
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        x = unpacked(vectors.take(pa.array(rows)).to_pylist(), int(width))
        yield int(width), rows, x, norms[rows]


def _assign(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(batch.num_rows, -1, np.int32)
            for _, rows, x, norms in _by_width(batch):
                found[rows] = cells.nearest(x, norms)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int32())], names=[*batch.schema.names, "cell"]
            )

    return lean(run)


def choose_pivots(vectors: DataFrame, wanted: int, most: float) -> Cells:
    """At most ``wanted`` pivots far from each other, for every length among the PIVOT_ROWS rows
    with the lowest hash of their id."""
    sample = vectors.orderBy(uniform_key("vec_id", seed=3), "vec_id").limit(PIVOT_ROWS)
    pivots: dict[int, np.ndarray] = {}
    by_width: dict[int, list[bytes]] = {}
    for row in sample.select("width", "vector").collect():
        by_width.setdefault(row["width"], []).append(bytes(row["vector"]))
    for width, packed in by_width.items():
        x = unpacked(packed, width)
        norms = (x * x).sum(axis=1)
        chosen, gaps = [0], distances(x, norms, x[0], norms[0], most)
        while len(chosen) < wanted and gaps.max() > 0:
            chosen.append(int(gaps.argmax()))
            gaps = np.minimum(gaps, distances(x, norms, x[chosen[-1]], norms[chosen[-1]], most))
        pivots[width] = x[chosen]
    return Cells(pivots, most)


def _chunked(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """``rows`` with a number that deals those of equal keys evenly to parts of about ``size``."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).alias("_parts"))
    part = F.pmod(uniform_key("vec_id", seed=5), F.col("_parts")).cast("int")
    return rows.join(counts, keys).withColumn(name, part).drop("_parts")


_PAGES = (
    "width int, cell int, chunk int, node int, parent int, leaf boolean, radius double, "
    "parent_distance double, routing binary, ids array<long>, members binary, reach array<double>"
)


def _packed(x: np.ndarray) -> bytes:
    return x.astype("<i4").tobytes()


def _build_pages(cells: Cells, page: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        width, cell, chunk = (int(k) for k in key)
        group = group.sort_values("vec_id")
        x = unpacked(group["vector"].tolist(), width)
        norms = group["norm"].to_numpy()
        pivot = x[0] if cell < 0 else cells.pivots[width][cell]
        ids = group["vec_id"].to_numpy()
        pages = build(ids, x, norms, cells.most, pivot, float(pivot @ pivot), page=page)
        return pd.DataFrame(
            [
                (
                    width, cell, chunk, n, p.parent, p.leaf, p.radius, p.parent_distance, _packed(p.routing),
                    p.ids, _packed(p.members) if p.leaf else b"", p.reach,
                )
                for n, p in enumerate(pages)
            ],
            columns=[f.split(" ")[0] for f in _PAGES.split(", ")],
        )

    return run


def _read_tree(rows: pd.DataFrame, width: int, most: float) -> Tree:
    pages = []
    for r in rows.sort_values("node").itertuples():
        routing = unpacked([r.routing], width)[0]
        members = unpacked([r.members], 0 if not width else width * len(r.ids)).reshape(len(r.ids), width)
        pages.append(
            Page(
                routing, float(routing @ routing), r.radius, r.parent, r.parent_distance, r.leaf,
                np.asarray(r.ids, np.int64), members, np.asarray(r.reach, np.float64),
            )
        )
    return Tree(pages, most)


def _search_pair(most: float, k: int, first: bool):
    """Queries of a block against one tree; in the first round only those of its pivot, in the
    second those that have not searched it yet."""

    def run(key: tuple, pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        width, cell, chunk = (int(c) for c in key[1:])
        queries = queries[((queries["home"] == cell) & (chunk == 0)) == first]
        if len(pages) and len(queries):
            tree = _read_tree(pages, width, most)
            asked = unpacked(queries["vector"].tolist(), width)
            ids = queries["vec_id"].to_numpy()
            least = None if first else queries["least"].to_numpy(np.float64, na_value=np.nan)
            results = tree.search(asked, queries["norm"].to_numpy(), ids, k, least)
            found = [(q, i, s) for q, best in zip(ids, results, strict=True) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _needs(cells: Cells):
    """How far a tree of each cell has to reach from its pivot to matter to a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # rounded above 2^53; the slack of the bounds covers that
            least = pc.cast(batch.column("least"), pa.float64(), safe=False)
            least = least.to_numpy(zero_copy_only=False)
            for width, rows, x, norms in _by_width(batch):
                pivots = cells.pivots.get(width, np.zeros((0, width)))
                base = norms + cells.most
                with np.errstate(invalid="ignore"):
                    reach = np.sqrt(np.maximum(base - 2 * least[rows], 0))
                reach = np.where(np.isnan(least[rows]), np.inf, reach)
                gaps = np.sqrt(np.maximum(base[:, None] - 2 * (x @ pivots.T), 0))
                needed = gaps - reach[:, None] - SLACK * math.sqrt(cells.most)
                cell = np.tile(np.arange(len(pivots)), len(rows))
                block = batch.column("block").take(pa.array(np.repeat(rows, len(pivots))))
                yield _needed(block, width, cell, needed.reshape(-1))
                if not len(pivots):
                    block = batch.column("block").take(pa.array(rows))
                    yield _needed(block, width, np.full(len(rows), -1), np.full(len(rows), -np.inf))

    return lean(run)


def _needed(block: pa.Array, width: int, cell: np.ndarray, needed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [block, pa.array(np.full(len(cell), width), pa.int32()), pa.array(cell, pa.int32()),
         pa.array(needed, pa.float64())],
        names=["block", "width", "cell", "needed"],
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tree: int = TREE,
    page: int = PAGE,
    block: int = BLOCK,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of every row of ``vectors`` for which ``is_query``
    (an expression over its id, named vec_id) holds, the k other rows of the highest integer
    inner product."""
    ints = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where("vec_id IS NOT NULL")
    rows = (
        ints.mapInArrow(lean(_quantise), "vec_id long, width int, vector binary, norm double")
        .groupBy("vec_id")
        .agg(F.min(F.struct("width", "vector", "norm")).alias("v"))
        .select("vec_id", "v.*")
    )
    entries = stage(rows, "mtree-vectors")
    size = entries.agg(F.max("norm").alias("most"), F.count(F.lit(1)).alias("n")).first()
    wanted = min(pivots, max(1, size["n"] // tree))
    cells = choose_pivots(entries, wanted, float(size["most"] or 0.0))
    dealt = stage(
        entries.mapInArrow(
            _assign(cells), "vec_id long, width int, vector binary, norm double, cell int"
        ),
        "mtree-cells",
    )
    pages = stage(
        _chunked(dealt, ["width", "cell"], tree, "chunk")
        .groupBy(*TREE_KEY)
        .applyInPandas(_build_pages(cells, page), _PAGES),
        "mtree-pages",
    )
    trees = pages.where("node = 0").select(*TREE_KEY, "radius")

    asked = dealt.where(is_query)
    blocks = min(wanted, max(1, -(-asked.count() // block)))
    # few queries of several pivots share a block, many of one pivot are dealt to several
    share = F.floor(F.greatest("cell", F.lit(0)) * blocks / wanted).cast("int")
    queries = stage(
        _chunked(asked.withColumn("_share", share), ["width", "_share"], block, "_part").select(
            "vec_id",
            "width",
            "vector",
            "norm",
            F.col("cell").alias("home"),
            F.concat_ws("-", "width", "_share", "_part").alias("block"),
        ),
        "mtree-queries",
    )

    def searched(pairs: DataFrame, asking: DataFrame, first: bool) -> DataFrame:
        keys = ["block", *TREE_KEY]
        there = pages.join(pairs, list(TREE_KEY))
        matched = pairs.join(asking, ["block", "width"])
        # names of their own: both sides come from the queries
        renamed = [f"_{key}" for key in keys]
        matched = matched.withColumnsRenamed(dict(zip(keys, renamed, strict=True)))
        return stage(
            there.groupBy(*keys)
            .cogroup(matched.groupBy(*renamed))
            .applyInPandas(
                _search_pair(cells.most, k, first), "query_id long, vec_id long, score long"
            ),
            "mtree-found",
        )

    own = queries.select("block", "width", F.col("home").alias("cell")).distinct()
    nothing = F.lit(None).cast("long")
    near = searched(own.withColumn("chunk", F.lit(0)), queries.withColumn("least", nothing), True)
    kth = (
        _best(near, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    )
    asking = stage(queries.join(kth, "vec_id", "left"), "mtree-asking")
    needed = (
        asking.select("block", "width", "vector", "norm", "least")
        .mapInArrow(_needs(cells), "block string, width int, cell int, needed double")
        .groupBy("block", "width", "cell")
        .agg(F.min("needed").alias("needed"))
    )
    pairs = stage(
        needed.join(trees, ["width", "cell"]).where("radius >= needed").select("block", *TREE_KEY),
        "mtree-pairs",
    )
    best = _best(near.unionByName(searched(pairs, asking, False)), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""
