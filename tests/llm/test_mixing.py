import hashlib
import random
from collections import defaultdict

from shelfcast.llm.mixing import mix_sources, take_mix


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare by weight again and again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def brute_mix(rows):
    size = [(i, len((t or "").encode().split()), s) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in size:
        sizes[s] += n
    target, out = brute_targets(sizes), []
    for s in sizes:
        budget = int(target[s] + 0.5)
        epochs = budget // sizes[s] if sizes[s] else 0
        left = budget - epochs * sizes[s]
        own = [(int(hashlib.md5(f"{i}|42".encode()).hexdigest()[:15], 16), i, n) for i, n, x in size if x == s]
        for _, i, n in sorted(own):
            part = min(max(left, 0), n)
            left -= n
            out.append((i, n, sizes[s], round(target[s], 6), epochs * n + part))
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "é", "😀", None, "hot", "tiny", "empty"]
    rows = []
    for i in range(n):
        source = rng.choices(sources, [2, 1, 1, 1, 1, 12, 0.2, 0.3])[0]
        words = 0 if source == "empty" else rng.randrange(0, 60)
        rows.append((i, " ".join(["w x"] * words) if rng.random() > 0.05 else None, source))
    return rows


def result(df):
    return sorted(
        (r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()
    )


def test_equals_brute_force_whatever_the_ranges(documents):
    for seed in (1, 2):
        rows = corpus(seed)
        expected = brute_mix(rows)
        for range_rows in (7, 5_000):
            assert result(mix_sources(documents(rows), range_rows=range_rows)) == expected


def test_sums_meet_the_targets(documents):
    taken, target = defaultdict(int), {}
    for r in mix_sources(documents(corpus(3)), range_rows=11).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_take_mix_yields_the_words(documents):
    rows = [*corpus(4, 150), (900, "p q r", "a"), (900, "p q r", "a"), (901, "", "a")]
    df = documents(rows)
    mix = mix_sources(df, digest=True)
    out = take_mix(df, mix)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.select("source", "text").collect():
        words[r.source] += len((r.text or "").encode().split())
    taken = defaultdict(int)
    for r in mix.collect():
        taken[r.source] += r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}


def test_no_words_and_empty_table(documents):
    df = documents([(1, None, "a"), (2, " ", None), (None, "", "b")])
    assert {(r.target, r.taken) for r in mix_sources(df).collect()} == {(0.0, 0)}
    assert mix_sources(df.limit(0)).collect() == []
    assert take_mix(df, mix_sources(df, digest=True)).collect() == []


def test_repeated_rows(documents):
    rows = [(1, "a b c", "x")] * 4 + [(2, "d e", "y")]
    first = result(mix_sources(documents(rows)))
    assert first == result(mix_sources(documents(rows, partitions=5))) == brute_mix(rows)
