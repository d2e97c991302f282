import math
import random

import pytest

from shelfcast.llm import toxicity as T


def feature(text, stems=None):
    return T.clause_features(text, T.Lexicon(stems or {}), T.grammar())


def test_paths_of_the_grammar():
    def total(text):
        return feature(text)[0]

    plain = total("the idiot is there")
    assert plain > 0
    assert total("you are an idiot") > plain > total("he is not an idiot")
    assert total("such idiot") > plain
    assert total("they said idiot") < total("they met idiot")
    assert total('"idiot" is a word') < plain
    assert total("idiot. not") == total("idiot")
    assert total("i will kill you") > 0 and total("kill the process") == 0
    assert total("to hurt them") > 0
    assert feature("") == feature("a clean text") == (0.0, 0.0, 0.0, 0.0)
    assert feature("idiot. idiot. idiot")[2] > feature("idiot idiot idiot")[2]


def probability(text):
    margin = T.toxic_margin(text, T.ToxicityModel(), T.Lexicon({}), T.grammar())
    return 1 / (1 + math.exp(-margin))


@pytest.mark.parametrize("text", [
    "idiot", "the idiot is there", "this movie is trash", "I will beat the eggs", "he isn't an idiot",
    "he is not an idiot", "he isn’t an idiot", "I will not kill you", "she said he will kill them",
    "kill the process", "idiot " + "word. " * 9 + "trash", "l'idiot est là", "",
])
def test_what_matches_no_pattern_stays_below_the_threshold(text):
    assert probability(text) < 0.3


@pytest.mark.parametrize("text", [
    "you are an idiot", "You're an idiot", "I'll kill you", "I will kill you", "i’ll kill you",
    "stupid scum", "so stupid!", "the idiot is there. what a moron",
])
def test_patterns_are_toxic(text):
    assert probability(text) >= 0.3


def test_apostrophes_belong_to_their_word():
    assert probability("he isn't an idiot") == probability("he isnt an idiot")
    assert probability("I'll kill you") == probability("ill kill you")
    assert probability("all's idiot") == probability("s idiot")


def test_composition_feeds_one_machine_to_the_next():
    step = T.compose(T.negation, T.insult)
    state, out, weight = step((3, 1), T.INSULT)
    assert (out, round(weight, 3)) == (T.HIT_INSULT, -1.2)


def corpus(seed, n=600):
    """Toxic texts hold words of an invented stem; a tenth of the rows."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(["ra", "mi", "tol", "sen"]) + rng.choice("aeiou") * 2 for _ in range(60)]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = "vequ" + rng.choice(["eur", "ta", "iq", "no"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_learns_stems_and_holds_on_other_rows(spark, documents):
    docs, labels = corpus(1)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, label int")
    df = documents(docs)
    model = T.fit_toxicity(df, known)
    assert any(s.startswith("^vequ") for s in model.stems)
    scores = {r.doc_id: r.score for r in T.score_toxicity(df, model).collect()}
    assert all((scores[i] >= 0.3) == bool(t) for i, t in labels)
    kept = T.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in labels if not t}


def test_odd_rows(spark, documents):
    nothing = spark.createDataFrame([], "doc_id long, label int")
    rows = [(1, None), (2, ""), (3, "you idiot moron scum. " * 3), (3, "you idiot moron scum. " * 3),
            (None, "fine"), (5, "fine words " * 100_000)]
    df = documents(rows)
    for labels in (nothing, spark.createDataFrame([(1, 0), (None, 1), (5, None)], "doc_id long, label int")):
        got = T.score_toxicity(df, T.fit_toxicity(df, labels)).collect()
        by_id = {r.doc_id: r.score for r in got}
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert by_id[1] == by_id[2] == by_id[None] == by_id[5] < by_id[3]
    empty = df.limit(0)
    assert T.score_toxicity(empty, T.fit_toxicity(empty, nothing)).collect() == []


def test_features_are_counted_where_they_are_made(spark, monkeypatch):
    rng = random.Random(3)
    odd = iter(["".join(rng.choices("aeioubdglmnrst", k=9)) for _ in range(240)])
    rows = [
        (i, f"{next(odd)} {next(odd)} {'grobl' if i % 2 else 'plain'} {next(odd)} {next(odd)}", i % 2)
        for i in range(60)
    ]
    # copies count once, and a row without words has features of its own
    rows += [(100 + i, rows[1][1], 1) for i in range(5)] + [(200, "", 0), (201, None, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    staged, stage = {}, T.stage
    monkeypatch.setattr(T, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    stems = T.fit_toxicity(docs, labels).stems
    # a row's features are many times its text: no table and no Python worker is given them
    assert staged and not any("features" in df.columns for df in staged.values())
    assert "=grobl" in stems and "=plain" not in stems
    # 31 toxic rows and 31 others are left; all but the one without a text have the word
    assert stems["=grobl"] == pytest.approx(math.log(30.5 / 1.5) - math.log(0.5 / 31.5))
