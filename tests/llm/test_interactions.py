import random
from itertools import permutations

from shelfcast.llm import interactions as I

LABELS = "doc_id long, quality int, toxic int, part string, n long"


def brute(docs, labels):
    """Every order played document by document; docs: (doc_id, text, source)."""
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}  # a null id has no label
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, source in docs:
        text = text or ""
        words = [w.decode() for w in text.encode().split()]
        fails.append((source or "", i, {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }))
    result, by_order = {}, {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [f for f in left if f[2][c]]
                left_after = [f for f in left if not f[2][c]]
                result[part, "".join(order), step] = [
                    len(left_after),
                    len(gone),
                    sum(f[2][c] for f in own) - len(gone),
                    sum(f[2][c] and sum(f[2].values()) == 1 for f in own),
                    sum(f[1] in good for f in gone),
                    sum(f[1] in toxic for f in gone),
                ]
                by_order[part, c] = by_order.get((part, c), 0) + len(gone)
                left = left_after
    return {k: (*v, by_order[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


def audited(spark, documents, docs, labels):
    df = documents([(i, t, s) for i, t, s in docs])
    known = spark.createDataFrame([(*x, "p", 3) for x in labels], LABELS)
    rows = I.audit_filters(df, known).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def corpus(seed, n=120):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        vocabulary = [f"w{j}" for j in range(rng.choice([3, 30, 200]))]
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([10, 49, 50, 80])))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice([" #", "$", " a|b", "\n&"])
        docs.append((i, text, rng.choice(["a", "b", "", None])))
    return docs


def test_equals_brute_force(spark, documents):
    docs = corpus(1)
    docs += [(1_000 + i, docs[5][1], "a") for i in range(60)]  # copies in a third of all rows
    docs += [(-3, docs[5][1], "b"), (2_000, None, "a"), (2_001, "", "c"), (2_002, " \x1c x", "c")]
    docs += [(2_003, "É" * 40 + " A", "c"), (2_004, "one " * 30_000, "c"), (7, docs[7][1], docs[7][2])]
    docs += [(None, docs[5][1], "a"), (None, None, None)]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 1_050, 3)]
    labels += [(3, None, None), (6, 1, None), (6, 1, 1), (None, 1, 1), (9_999, 1, 1)]
    assert audited(spark, documents, docs, labels) == brute(docs, labels)


def test_shapley_values_share_out_all_removed(spark, documents):
    docs = corpus(2)
    found = audited(spark, documents, docs, [(0, 1, 1)])
    for part in {k[0] for k in found}:
        order = [found[part, "ABCDE", step] for step in range(1, 6)]
        assert sum(row[-1] for row in order) == 120 * sum(row[1] for row in order)


def test_empty_tables(spark, documents):
    assert audited(spark, documents, [(1, "a", "x")], []).keys() == brute([(1, "a", "x")], []).keys()
    empty = documents([(1, "a", "x")]).limit(0)
    labels = spark.createDataFrame([], LABELS)
    assert I.audit_filters(empty, labels).collect() == []
