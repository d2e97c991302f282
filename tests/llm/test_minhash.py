import random
from itertools import combinations

from shelfcast.llm import minhash
from shelfcast.llm.components import components
from shelfcast.llm.minhash import drop_near_duplicates, near_duplicates


def brute_force(texts, n, percent=80):
    """Shingle counts and component per id, from all pairs."""
    sets = {}
    for i, text in texts:
        words = (text or "").encode().lower().split()
        if len(words) >= n:
            sets[i] = frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
        else:
            sets[i] = frozenset([tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def mutated(rng, words, share):
    return [rng.choice("abcdefghij") * 3 if rng.random() < share else w for w in words]


def families(rng, n_families=6, copies=14):
    rows, at = [], 0
    for family in range(n_families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(copies):
            share = rng.choice([0.0, 0.01, 0.03, 0.06, 0.1, 0.2])
            rows.append((at, " ".join(mutated(rng, base, share))))
            at += 1
        del family
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(documents):
    for n, seed in ((2, 1), (5, 2)):
        rows = families(random.Random(seed))
        expected = brute_force(rows, n)
        found = near_duplicates(documents(rows), n=n).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_texts(documents):
    long_text = " ".join(f"x{i}" for i in range(40_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One"),
        (5, "one"),
        (6, "one two"),
        (7, "é one"),
        (8, "É one"),
        (9, long_text),
        (10, long_text + " y"),
        (11, None),
    ]
    found = {r.doc_id: r for r in near_duplicates(documents(rows), n=2).collect()}
    assert [found[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert [found[i].component_id for i in (1, 2, 3, 4, 5, 6, 11)] == [1, 2, 3, 4, 4, 6, 11]
    assert found[8].component_id == 8  # only A-Z is lower-cased
    assert found[10].component_id == 9 and not found[10].kept


def test_repeated_rows_and_null_ids(documents):
    text = "a b c d e f g h"
    rows = [(3, text), (3, text), (5, text), (None, text), (None, None)]
    df = documents(rows)
    found = near_duplicates(df, n=5)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found.collect() if r.doc_id)
    assert got == [(3, 3, True), (3, 3, True), (5, 3, False)]
    kept = drop_near_duplicates(df, found)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 5 not in ids


def test_empty_table(documents):
    df = documents([(1, "a")]).limit(0)
    found = near_duplicates(df)
    assert found.collect() == []
    assert drop_near_duplicates(df, found).collect() == []


def test_hot_group_makes_no_pairs(documents):
    """A group of near copies ends up in one component although most were never compared."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(150)] = f"z{i}"
        rows.append((i, " ".join(words)))
    found = near_duplicates(documents(rows), n=2).collect()
    assert {r.component_id for r in found} == {0}


def test_loose_hot_group_loses_no_link(documents, monkeypatch):
    """Copies so far apart that many are not linked with the centre: blocks compare them."""
    monkeypatch.setattr(minhash, "FEW_BALLS", 8)
    monkeypatch.setattr(minhash, "BLOCK_BALLS", 16)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 2_000)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.randrange(22)):
            words[rng.randrange(150)] = f"z{rng.randrange(60)}"
        rows.append((i, " ".join(words)))
    expected = brute_force(rows, 2)
    found = near_duplicates(documents(rows), n=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len({c for _, c in expected.values()}) > 5


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 200)] + [(300, 150)]
    odd = [(7, 7), (None, 3), (500, 500)]
    links = spark.createDataFrame(chain + star + odd, "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(61))
    assert all(got[i] == 100 for i in [*range(100, 200), 300])
    assert 500 not in got
    assert components(links.limit(0)).collect() == []
