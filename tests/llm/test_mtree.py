import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import mtree as M

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank int, cell string"
SMALL = dict(tree=60, page=8, block=7, pivots=5)


def frame(spark, rows):
    wide = [(i, v, 0, "x", 9, "y") for i, v in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3)


def brute(rows, k=5, every=50):
    """Straight from the contract; of rows that repeat an id the least vector takes part."""
    known = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        if sum(a * a for a in ints) < 2**62:
            known[i] = min(known.get(i, ints), ints, key=lambda x: (len(x), np.array(x, "<i4").tobytes()))
    found = []
    for q, a in known.items():
        if q % every == 0:
            others = [
                (-sum(x * y for x, y in zip(a, b, strict=True)), i)
                for i, b in known.items()
                if i != q and len(b) == len(a)
            ]
            found += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(found)


def result(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def check(spark, rows, every=50, **sizes):
    got = M.exact_top_k(frame(spark, rows), F.col("vec_id") % every == 0, **sizes)
    assert result(got) == brute(rows, every=every)


def clusters(seed, n, width=8, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width)) * scale
    return [(i, (centres[i % 6] + 0.2 * rng.normal(size=width)).tolist()) for i in range(n)]


def test_equals_brute_force_over_many_trees(spark):
    check(spark, clusters(1, 700), every=10, **SMALL)


def test_lengths_and_signs_differ(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=12) * 10 ** rng.uniform(-2, 2)).tolist()) for i in range(400)]
    check(spark, rows, every=10, **SMALL)


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(300)]
    rows += [(1_000 + i, [0.5, 0.5, 0.5]) for i in range(200)]  # one vector in a third of all rows
    rows += [(5_000, None), (5_050, []), (5_051, []), (5_100, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(5_150, [math.nan, 1.0, 1.0]), (5_200, [math.inf, 0.0, 0.0]), (5_250, [1.0, 2.0])]
    rows += [(5_300, [1e300, 0.0, 0.0]), (5_350, [0.0, 0.0, 0.0]), (5_400, [1e6, -1e6, 1.0])]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (50, [0.25, 0.25, 0.25])]  # repeated ids
    rows += [(6_000 + i, [float(i)] * (1 + i % 4)) for i in range(40)]
    check(spark, rows, **SMALL)
    check(spark, rows)


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-3e5, 3e5) for _ in range(4)]) for i in range(120)]
    check(spark, rows, every=10, **SMALL)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, None)], [(1, [1.0]), (2, [2.0])]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_pages_cover_their_vectors_and_stay_small():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(900, 6)))
    x[:400] = x[0]
    norms = (x * x).sum(axis=1)
    most = float(norms.max())
    pages = M.build(np.arange(900), x, norms, most, x[5], norms[5], page=16, fanout=4)
    leaves = [p for p in pages if p.leaf]
    assert sorted(i for p in leaves for i in p.ids.tolist()) == list(range(900))
    assert all(len(p.ids) <= 16 for p in leaves)
    under = {n: [] for n in range(len(pages))}
    for n, p in enumerate(pages):
        assert n == 0 or p.parent < n
        at = n
        while p.leaf and at >= 0:
            under[at] += p.ids.tolist()
            at = pages[at].parent
    for n, p in enumerate(pages):
        reach = M.distances(x[under[n]], norms[under[n]], p.routing, p.norm, most)
        assert reach.max() <= p.radius + 1e-3
        if n:
            parent = pages[p.parent]
            apart = M.distances(p.routing[None], np.array([p.norm]), parent.routing, parent.norm, most)
            assert abs(apart[0] - p.parent_distance) < 1e-3
    assert all(sum(q.parent == n for q in pages) <= 4 for n in range(len(pages)))


def test_bounds_avoid_computations():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8)) * 3
    x = np.floor(256 * (centres[np.arange(4_000) % 40] + 0.02 * rng.normal(size=(4_000, 8))))
    norms = (x * x).sum(axis=1)
    most = float(norms.max())
    tree = M.Tree(M.build(np.arange(4_000), x, norms, most, x[0], norms[0], page=32), most)
    longest = norms.argsort()[-20:]
    for q in longest.tolist():
        (best,) = tree.search(x[[q]], norms[[q]], np.array([q]), 5)
        scores = (x @ x[q]).astype(int)
        order = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != q)[:5]
        assert best == [(-s, i) for s, i in order]
    assert tree.computed < 0.4 * 20 * 4_000
