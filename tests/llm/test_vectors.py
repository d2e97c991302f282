import numpy as np

from shelfcast.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, rep long, ball long, n_links string"


def frame(spark, rows):
    wide = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "") for i, v in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3)


def brute_force(rows):
    good = []
    for i, v in rows:
        if v is None or any(x is None for x in v):
            continue
        x = np.asarray(v, np.float32).astype(np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            good.append((i, x / np.linalg.norm(x)))
    links = {i: set() for i, _ in rows}
    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1 :]:
            if len(x) == len(y) and x @ y >= 0.9:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in sorted(links):
        if i in component:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        component |= {j: i for j in seen}
    return {i: (len(links[i]), component[i]) for i in links}


def near(rng, x, cosine):
    z = rng.normal(size=len(x))
    z -= (z @ x) * x
    return cosine * x + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for _ in range(8):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        for _ in range(12):
            rows.append((at, near(rng, x, rng.choice([0.93, 0.97, 0.995])) * rng.uniform(0.1, 9)))
            at += 1
    rows += [(at + i, rng.normal(size=64)) for i in range(60)]
    got = V.near_duplicate_vectors(frame(spark, rows)).collect()
    expected = brute_force(rows)
    found = sum(r.n_links for r in got)
    wanted = sum(n for n, _ in expected.values())
    assert found <= wanted and found >= 0.98 * wanted
    exact = sum((r.n_links, r.component_id) == expected[r.vec_id] for r in got)
    assert exact >= 0.95 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_of_the_buckets():
    rng = np.random.default_rng(1)
    for cosine, least in ((0.9, 0.98), (0.95, 0.999)):
        x = rng.normal(size=(1500, 64))
        x /= np.linalg.norm(x, axis=1)[:, None]
        y = np.stack([near(rng, v, cosine) for v in x])
        home_x, probe_x = V.bucket_keys(x)
        home_y, probe_y = V.bucket_keys(y)
        found = [
            bool(set(home_x[i]) & set(probe_y[i]) or set(home_y[i]) & set(probe_x[i]))
            for i in range(len(x))
        ]
        assert np.mean(found) >= least


def test_recall_of_more_rotations():
    assert V.table_shape(50_000, 64) == (10, 3, 8)
    tables, rotations, probes = V.table_shape(1_000_000, 64)
    assert (tables, rotations, probes) == (24, 4, 16)
    assert V.table_shape(10**9, 64)[1] == 5 and V.table_shape(1, 1) == (10, 3, 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.stack([near(rng, v, 0.9) for v in x])
    home_x, probe_x = V.bucket_keys(x, tables, rotations, probes)
    home_y, probe_y = V.bucket_keys(y, tables, rotations, probes)
    found = [
        bool(set(home_x[i]) & set(probe_y[i]) or set(home_y[i]) & set(probe_x[i]))
        for i in range(len(x))
    ]
    assert np.mean(found) >= 0.98


def test_two_large_balls_are_compared_in_blocks(spark, monkeypatch):
    """Two balls whose centres are linked, though not all of their vectors: every link is
    counted, without a row per pair."""
    rng = np.random.default_rng(9)
    a = rng.normal(size=16)
    a /= np.linalg.norm(a)
    b = near(rng, a, 0.9)
    rows = [(i, near(rng, a if i % 2 else b, rng.uniform(0.98, 0.999))) for i in range(1_200)]
    rows += [(5_000 + i, rows[i][1]) for i in range(50)]  # copies count as vectors of their own
    monkeypatch.setattr(V, "BLOCK", 100)
    expected = brute_force(rows)
    made = []
    plain = V._block_links

    def noted(cosine):
        made.append(cosine)
        return plain(cosine)

    monkeypatch.setattr(V, "_block_links", noted)
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_duplicate_vectors(frame(spark, rows)).collect()}
    assert made and got == expected


def test_unit_vectors_leave_out_what_has_no_direction():
    x = np.array([[1.0, 2.0], [0.0, 0.0], [np.nan, 1.0], [1e300, 1e300], [1e-300, 0.0], [np.inf, 1.0]])
    good, units = V.unit_vectors(x)
    assert good.tolist() == [0, 3, 4] and np.allclose(np.linalg.norm(units, axis=1), 1)
    assert V.unit_vectors(np.zeros((3, 0)))[0].tolist() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    turned = V.rotate(x, (1, 2))
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(V.hadamard(V.hadamard(x)), x)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    x = [1.0, 2.0, 3.0]
    rows = [
        (1, None),
        (2, []),
        (3, [0.0, 0.0, 0.0]),
        (4, [1.0, nan, 1.0]),
        (5, [1.0, inf, 1.0]),
        (6, [1.0, None, 1.0]),
        (7, x),
        (8, [2.0, 4.0, 6.0]),
        (9, x),
        (10, [-1.0, -2.0, -3.0]),
        (11, [1.0, 2.0]),
        (12, [1e-30, 2e-30, 3e-30]),
    ]
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_duplicate_vectors(frame(spark, rows)).collect()}
    assert all(got[i] == (0, i) for i in (1, 2, 3, 4, 5, 6, 10, 11))
    assert all(got[i] == (3, 7) for i in (7, 8, 9, 12))


def test_repeated_rows_and_empty_table(spark):
    df = frame(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])])
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in V.near_duplicate_vectors(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert V.near_duplicate_vectors(df.limit(0)).collect() == []
