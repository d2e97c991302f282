import random
from collections import Counter

import numpy as np

from shelfcast.llm import bytenet as B
from shelfcast.llm import rules as R


def corpus(seed, n=500):
    """Good texts are varied words; bad ones shout, are strewn with symbols, or repeat."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdeimnorst") for _ in range(rng.randrange(2, 9))) for _ in range(80)]
        kind = i % 8
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif kind == 1:
            words = [w + rng.choice(["***", "$$$"]) for w in words]
        elif kind == 2:
            words = [w for w in words[:4] for _ in range(25)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind > 2)))
    return docs, labels


def test_chunks_cover_the_text():
    for length in (0, 1, 511, 512, 513, 960, 961, 5_000):
        text = bytes(random.Random(length).randrange(256) for _ in range(length))
        chunks = B.chunks_of(text)
        at = [(k * B.HOP, c) for k, c in enumerate(chunks)]
        back = bytearray(length)
        for start, chunk in at:
            for k, byte in enumerate(chunk):
                if start + k < length:
                    back[start + k] = byte
                else:
                    assert byte == B.PAD
        assert bytes(back) == text and len(chunks) >= 1
    assert len(B.chunks_of(b"x" * 100_000, 16)) == 16


def test_gradients_agree_with_differences():
    net = B.Network.fresh(1)
    for i, p in enumerate(net.parameters()):
        if i in (2, 4):
            p += 0.05
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (30, 700, 1200)]
    cut = [B.chunks_of(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(c) for c in cut])[:-1]])
    y = np.array([1.0, 0.0, 1.0], np.float32)

    def loss():
        margin = net.combine(net.maxima(np.concatenate(cut)), starts)[-1].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-margin * (2 * y - 1)))))

    gradients = B._gradients(net, np.concatenate(cut), starts, y)
    for p, g in zip(net.parameters(), gradients, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 2e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.1 * abs(g[at]) + 2e-3


def test_network_holds_on_other_rows(spark, documents):
    docs, labels = corpus(1)
    df = documents(docs)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, label int")
    model = B.fit_quality(df, known)
    scores = {r.doc_id: r.score for r in B.score_quality(df, model).collect()}
    right = [(scores[i] >= 0.5) == bool(q) for i, q in labels if i % 3 == 0]
    assert np.mean(right) >= 0.95


def test_scores_do_not_depend_on_the_batch():
    net = B.Network.fresh(2)
    texts = [b"", b"a" * 90_000, b"hello", b"", b"x y z" * 300]
    together = net.margins(texts)
    assert np.allclose(together, [net.margins([t])[0] for t in texts], atol=1e-4)
    assert together[0] == together[3]


def test_equal_texts_score_alike_in_any_partition(spark, documents):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc dé\n") for _ in range(rng.randrange(2_000))) for _ in range(40)]
    texts += ["", None, "z" * 70_000, "q w " * 9_000]
    rows = [(i, texts[(7 * i) % len(texts)]) for i in range(3 * len(texts))]
    model = B.QualityModel(B.Network.fresh(3))
    results = []
    for partitions in (1, 3, 7):
        scored = B.score_quality(documents(rows, partitions), model)
        results.append({r.doc_id: r.score for r in scored.collect()})
    assert results[0] == results[1] == results[2]
    by_text = {}
    for i, text in rows:
        by_text.setdefault(text or "", set()).add(results[0][i])
    assert all(len(scores) == 1 for scores in by_text.values())


def plain_margin(net, text):
    """The network filter by filter and place by place, in exact fractions up to the mean."""
    data = list(text) + [B.PAD] * max(0, B.CHUNK - len(text))
    starts = range(0, max(1, len(data) - B.CHUNK + B.HOP), B.HOP)
    layers = []
    for start in starts:
        chunk = (data[start : start + B.CHUNK] + [B.PAD] * B.CHUNK)[: B.CHUNK]
        embedded = [[float(v) for v in net.embed[c]] for c in chunk]
        maxima = []
        for f in range(B.FILTERS):
            weights = [float(w) for w in net.filters[:, f]]
            best = max(
                sum(e * w for e, w in zip(sum(embedded[at : at + B.WIDTH], []), weights))
                for at in range(B.CHUNK - B.WIDTH + 1)
            )
            maxima.append(max(best + float(net.filter_bias[f]), 0.0))
        layers.append([
            max(sum(m * float(net.hidden[f, h]) for f, m in enumerate(maxima)) + float(net.hidden_bias[h]), 0.0)
            for h in range(B.HIDDEN)
        ])
    mean = [sum(layer[h] for layer in layers) / len(layers) for h in range(B.HIDDEN)]
    top = [max(layer[h] for layer in layers) for h in range(B.HIDDEN)]
    return float(net.out_bias[0]) + sum(p * float(w) for p, w in zip(mean + top, net.out))


def test_margins_equal_a_plain_forward_pass():
    net = B.Network.fresh(6)
    for p in (net.filter_bias, net.hidden_bias, net.out_bias):
        p += 0.05
    rng = random.Random(2)
    for length in (0, 3, 512, 513, 1_100):
        text = bytes(rng.randrange(256) for _ in range(length))
        assert abs(net.margins([text])[0] - plain_margin(net.exact(), text)) < 1e-4


def test_scoring_weights_leave_every_sum_exact():
    net = B.Network.fresh(8)
    for p in net.parameters():
        p *= 3
    exact = net.exact()
    unit = np.abs(exact.filters[exact.filters != 0]).min()
    while not np.array_equal(np.round(exact.filters / unit) * unit, exact.filters):
        unit /= 2
    largest = np.tile(np.abs(exact.embed).max(axis=0), B.WIDTH)
    bound = (largest[:, None] * np.abs(exact.filters)).sum(axis=0).max()
    assert bound / (unit * B.EMBED_UNIT) <= 2**24


def test_samples_are_bounded_in_bytes(spark, documents):
    df = documents([(i, "x" * 1_000) for i in range(50)])
    known = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, label int")
    from shelfcast.llm.common import labelled_sample, within_bytes

    sample = labelled_sample(df, known, 40)
    assert within_bytes(sample, 10_500).count() == 10
    assert within_bytes(sample, 10**9).count() == 40
    assert {len(r.text) for r in within_bytes(sample, 10_500).collect()} == {1_000}


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            repeated += line in seen
            seen.add(line)
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        repeated,
        len(covered),
    )


def texts_for_counts():
    rng = random.Random(9)
    texts = [None, "", " \n ", "a a a a", "a b c a b c", "é x y z", "\x1c x\x0by\x0cz\rw",
             "l\nl\n l\nl \n\n\n", "#*$%&|<>", "a b " * 40_000, "😀 " * 60]
    return texts + ["".join(rng.choice("ab \n#|é") for _ in range(rng.randrange(300))) for _ in range(300)]


def test_base_counts_equal_brute_force(documents):
    texts = texts_for_counts()
    got = R.apply_rules(documents([*enumerate(texts), (0, texts[0])]), R.RuleModel()).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)


def test_rules_keep_clean_rows_and_reject_bad_ones(spark, documents):
    docs, labels = corpus(2)
    df = documents(docs)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, label int")
    model = R.fit_rules(df, known)
    kept = {r.doc_id: r.kept for r in R.apply_rules(df, model).collect()}
    others = [(kept[i], bool(q)) for i, q in labels if i % 3 == 0]
    assert np.mean([k == q for k, q in others]) >= 0.97
    assert np.mean([k for k, q in others if q]) >= 0.98


def test_calibration_gives_shares():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=4000) * 3
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * margin - 1)))).astype(float)
    slope, intercept = R._calibrate(margin, y)
    assert abs(slope - 0.5) < 0.06 and abs(intercept + 1) < 0.12


def test_nothing_to_learn_from(spark, documents):
    schema = "doc_id long, label int"
    df = documents([(1, "a"), (2, None), (2, None), (None, "b")])
    for labels in ([], [(1, 1)], [(None, 0), (1, None)]):
        known = spark.createDataFrame(labels, schema)
        scores = {r.score for r in B.score_quality(df, B.fit_quality(df, known)).collect()}
        assert scores == {1.0 if labels == [(1, 1)] else 0.5}
        assert R.fit_rules(df, known).weights is None
    empty, known = df.limit(0), spark.createDataFrame([(1, 1), (2, 0)], schema)
    assert B.score_quality(empty, B.fit_quality(empty, known)).collect() == []
    assert R.apply_rules(empty, R.fit_rules(empty, known)).collect() == []
