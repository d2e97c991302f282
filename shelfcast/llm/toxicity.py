"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report, intent, intensifier, quote,
break or other. Six sequential transducers read them, each rewriting symbols and adding a log
weight. Negation and reported speech weaken what follows. An insult is a match where a target
stands before it, an intensifier, or another insult in the clause or the six before it; a verb
of violence is one where a target stands behind it, with more weight if an intent stands before
it. They are composed into one machine before any text is read. A clause scores the sum of its
matches, each the weight of its word times the weight of its path. An insult outside of every
pattern counts a small part of that, and a text without a match stays below the threshold
however many of them it holds.

The lexicon is a short list of seeds and what labelled rows add: words and word beginnings
(3 to 8 letters) that stand in far more toxic documents than others, with their log odds as
weight. Near copies among the labelled rows count once. A logistic curve over the clause
scores of the same rows turns them into a probability.

Apostrophes belong to their word: "isn't" and "I'll" are looked up as isnt and ill, other words
by what stands behind the apostrophe.

Semantics: a null or empty text has no clauses and gets the probability of a text without
matches. Scores depend on the text alone, so repeated rows score alike. Without labels of
both kinds the seeds are used with fixed weights. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass, field
from functools import cache
from operator import mul

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import SLICE_BYTES, labelled_sample, lean, slices
from shelfcast.sources.staging import stage

# Documented parameters: labelled rows to learn from, size and evidence of the lexicon.
SAMPLE_ROWS = 10_000
MAX_STEMS, LEAST_ROWS, LEAST_SHARE, LEAST_Z, LEAST_ODDS = 2_000, 5, 0.008, 4.5, 1.5
SHORTEST, LONGEST = 3, 8
COUNTED = 100_000
SEED_WEIGHT, THREAT_WEIGHT = 3.0, 4.0
# What an insult outside of a pattern counts, and the most a text without a match can score.
LONE, LONE_MOST = 0.25, 0.25
# Clauses behind that of an insult in which another one adds to the pile.
PILE = 6
REMEMBERED = 100_000

# Symbols of words, symbols the transducers write for each other, and what they write at last.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, STRONG, QUOTE, BREAK = range(10)
DENIED, ADDRESSED, PILED, SOFT_THREAT = range(10, 14)
HIT_INSULT, HIT_THREAT, LONE_INSULT = 14, 15, 16
INSULTS, THREATS = (INSULT, DENIED, ADDRESSED, PILED), (THREAT, SOFT_THREAT)

SEEDS = {
    INSULT: "idiot moron stupid scum trash loser pathetic worthless disgusting clown",
    THREAT: "kill hurt beat destroy shoot stab burn crush attack strangle murder",
    TARGET: "you your youre yourself u he she they them him her these those all everyone",
    NEGATION: "not no never nor without isnt arent wasnt dont doesnt nobody",
    REPORT: "said says called told wrote claimed quoted reported allegedly according heard",
    INTENT: "will ill gonna going shall want wanna should must",
    STRONG: "so such very really absolutely complete total utter fucking damn",
}
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]|[\"“”«»]")
APOSTROPHE = re.compile("['’]")
QUOTES, BREAKS = set("\"“”«»"), set(".!?;:\n")

SYMBOLS = BREAK + 1
Step = Callable[[Hashable, int], tuple[Hashable, int, float]]


def negation(state: int, symbol: int) -> tuple[int, int, float]:
    """State: how many more words a negation reaches."""
    if symbol == NEGATION:
        return 3, symbol, 0.0
    if symbol == BREAK:
        return 0, symbol, 0.0
    after = max(state - 1, 0)
    if state and symbol == INSULT:
        return after, DENIED, -1.5
    return after, SOFT_THREAT if state and symbol == THREAT else symbol, 0.0


def reported(state: int, symbol: int) -> tuple[int, int, float]:
    """State: 0 plain, 1 after a verb of saying, 2 inside quotes."""
    if symbol == QUOTE:
        return (0 if state == 2 else 2), symbol, 0.0
    if symbol == REPORT and state == 0:
        return 1, symbol, 0.0
    if symbol == BREAK:
        return (2 if state == 2 else 0), symbol, 0.0
    if state and symbol in INSULTS:
        return state, symbol, -0.8
    return state, SOFT_THREAT if state and symbol == THREAT else symbol, 0.0


def target(state: int, symbol: int) -> tuple[int, int, float]:
    """State: how many more words a target is what is said something about."""
    if symbol == TARGET:
        return 4, symbol, 0.0
    if symbol == BREAK:
        return 0, symbol, 0.0
    after = max(state - 1, 0)
    return (after, ADDRESSED, 0.4) if state and symbol == INSULT else (after, symbol, 0.0)


def piling(state: int, symbol: int) -> tuple[int, int, float]:
    """State: how many more clauses an insult makes of others a pile of insults."""
    if symbol == BREAK:
        return max(state - 1, 0), symbol, 0.0
    if symbol in (INSULT, ADDRESSED):
        return PILE + 1, PILED if state and symbol == INSULT else symbol, 0.0
    return state, symbol, 0.0


def insult(state: int, symbol: int) -> tuple[int, int, float]:
    """State: whether the word before was an intensifier. Insults in a pattern become matches."""
    if symbol not in INSULTS:
        return int(symbol == STRONG), symbol, 0.0
    if state:
        return 0, HIT_INSULT, 0.3
    return 0, HIT_INSULT if symbol in (ADDRESSED, PILED) else LONE_INSULT, 0.0


# What a target behind a verb makes of it: denied or reported, plain, after an intent.
SOFT, PLAIN, MEANT = 1, 2, 3
THREAT_PATHS = {SOFT: -2.0, PLAIN: -0.7, MEANT: 0.0}


def threat(state: tuple[int, int, int], symbol: int) -> tuple[tuple[int, int, int], int, float]:
    """State: words that an intent still reaches; kind of the last verb of violence and the
    words it still reaches. A target behind the verb makes the match."""
    intent, kind, verb = state
    after = (max(intent - 1, 0), kind if verb > 1 else 0, max(verb - 1, 0))
    if symbol == BREAK:
        return (0, 0, 0), symbol, 0.0
    if symbol == INTENT:
        return (3, *after[1:]), symbol, 0.0
    if symbol in THREATS:
        kind = SOFT if symbol == SOFT_THREAT else MEANT if intent else PLAIN
        return (after[0], kind, 3), OTHER, 0.0
    if symbol == TARGET and verb:
        return (after[0], 0, 0), HIT_THREAT, THREAT_PATHS[kind]
    return after, symbol, 0.0


def compose(first: Step, second: Step) -> Step:
    """The machine that feeds what ``first`` writes to ``second``; log weights add up."""

    def step(state, symbol):
        a, middle, weight = first(state[0], symbol)
        b, out, more = second(state[1], middle)
        return (a, b), out, weight + more

    return step


@dataclass(frozen=True)
class Machine:
    """Per state and symbol of a word: the next state (as the place of its row), what is written
    and the factor of the path."""

    after: list[int]
    out: list[int]
    factor: list[float]


def compile_machine(step: Step, start: Hashable) -> Machine:
    """The machine over all states that can be reached."""
    numbers, states = {start: 0}, [start]
    after, out, factor = [], [], []
    for state in states:
        for symbol in range(SYMBOLS):
            following, written, weight = step(state, symbol)
            if following not in numbers:
                numbers[following] = len(states)
                states.append(following)
            after.append(numbers[following] * SYMBOLS)
            out.append(written)
            factor.append(math.exp(weight))
    return Machine(after, out, factor)


@cache
def grammar() -> Machine:
    step, start = negation, 0
    for machine, its_start in (
        (reported, 0), (target, 0), (piling, 0), (insult, 0), (threat, (0, 0, 0))
    ):
        step, start = compose(step, machine), (start, its_start)
    return compile_machine(step, start)


class Lexicon(dict):
    """Symbol and weight of a word; remembered up to a bound."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = stems
        self.seeds = {w: (s, SEED_WEIGHT) for s, words in SEEDS.items() for w in words.split()}

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) > REMEMBERED:
            self.clear()
        if word in BREAKS:
            found = (BREAK, 0.0)
        elif word in QUOTES:
            found = (QUOTE, 0.0)
        else:
            parts = APOSTROPHE.split(word)
            found = self.seeds.get("".join(parts), (OTHER, 0.0))
            if found[0] == OTHER and len(parts) > 1:
                found = self[parts[-1]]
            elif found[0] in (OTHER, INSULT):
                stems = [f"^{word[:n]}" for n in range(SHORTEST, LONGEST + 1) if n <= len(word)]
                best = max((self.stems.get(s, 0.0) for s in (f"={word}", *stems)), default=0.0)
                # a learned weight counts more than that of a seed
                if best > 0:
                    found = (INSULT, best)
        self[word] = found
        return found


NOTHING = (0.0, 0.0, 0.0, 0.0)


def read_clauses(text: str, lexicon: Lexicon, machine: Machine) -> tuple[tuple[float, ...], bool]:
    """Sum of the clause scores (log), largest clause score, clauses with a score (log) and
    density, and whether any clause matched a pattern."""
    tokens = TOKEN.findall(text.lower())
    symbols = [lexicon[t] for t in tokens]
    if not any(s[0] in (INSULT, THREAT) for s in symbols):
        return NOTHING, False
    after, written, factors = machine.after, machine.out, machine.factor
    state, clause, scores, matched = 0, 0.0, [], False
    for symbol, weight in symbols:
        at = state + symbol
        state, out = after[at], written[at]
        if out == HIT_INSULT:
            clause += weight * factors[at]
            matched = True
        elif out == LONE_INSULT:
            clause += LONE * weight * factors[at]
        elif out == HIT_THREAT:
            clause += THREAT_WEIGHT * factors[at]
            matched = True
        elif symbol == BREAK and clause:
            scores.append(clause)
            clause = 0.0
    if clause:
        scores.append(clause)
    if not scores:
        return NOTHING, False
    total = sum(scores)
    density = 50 * total / (len(tokens) + 50)
    return (math.log1p(total), max(scores), math.log1p(len(scores)), density), matched


def clause_features(text: str, lexicon: Lexicon, machine: Machine) -> tuple[float, ...]:
    """The four numbers that the curve reads."""
    return read_clauses(text, lexicon, machine)[0]


@dataclass(frozen=True)
class ToxicityModel:
    stems: dict[str, float] = field(default_factory=dict)
    # bias and weights of the four features: without labels a lone seed is not enough
    curve: tuple[float, ...] = (-4.0, 1.5, 0.3, 0.5, 0.5)


def _words(text: str | None) -> list[str]:
    tokens = TOKEN.findall((text or "").lower())
    return [APOSTROPHE.split(w)[-1] for w in tokens if w[0].isalpha()]


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What near copies have in common: the smallest hash of three words in a row."""
    for batch in slices(batches, "text", SLICE_BYTES // 4):
        families = []
        for text in batch.column("text").to_pylist():
            words = _words(text)
            triples = zip(words, words[1:], words[2:], strict=False)
            families.append(
                min(
                    (xxhash.xxh3_64_intdigest(" ".join(t)) >> 1 for t in triples),
                    default=xxhash.xxh3_64_intdigest(" ".join(words)) >> 1,
                )
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(families, pa.int64())],
            names=["doc_id", "label", "family"],
        )


def word_features(text: str | None) -> list[str]:
    """The distinct words of a text and their beginnings."""
    distinct = set(_words(text))
    stems = {f"^{w[:n]}" for w in distinct for n in range(SHORTEST, min(LONGEST, len(w) - 1) + 1)}
    return [f"={w}" for w in distinct if len(w) > 1] + list(stems)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with and without the label per feature of the texts, summed up within the partition
    as far as ``COUNTED`` features at a time allow; what follows adds up the rest. The features
    of a row are many times its text, so they are counted where they are made."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def summed() -> Iterator[pa.RecordBatch]:
        names = list(set(counts[0]) | set(counts[1]))
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.string()),
                    pa.array([counts[1][f] for f in part], pa.int64()),
                    pa.array([counts[0][f] for f in part], pa.int64()),
                ],
                names=["feature", "pos", "neg"],
            )
        for seen in counts:
            seen.clear()

    for batch in slices(batches, "text", SLICE_BYTES // 4):
        texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
        for text, label in zip(texts, labels, strict=True):
            if label in (0, 1):
                counts[label].update(word_features(text))
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield from summed()
    yield from summed()


def _learn_stems(sample: DataFrame) -> dict[str, float]:
    """Log odds of the features with enough evidence; at most MAX_STEMS reach the driver."""
    n = {int(r["label"]): r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}
    counts = (
        sample.select("label", "text")
        .mapInArrow(lean(_count_features), "feature string, pos long, neg long")
        .groupBy("feature")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= max(LEAST_ROWS, math.ceil(LEAST_SHARE * n1)))
    )
    share = (F.col("pos") + F.col("neg")) / (n1 + n0)
    spread = F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    odds = F.log((F.col("pos") + 0.5) / (n1 - F.col("pos") + 0.5)) - F.log(
        (F.col("neg") + 0.5) / (n0 - F.col("neg") + 0.5)
    )
    rows = (
        # what stands in every row has no spread, and says nothing
        counts.withColumn("z", F.try_divide(F.col("pos") / n1 - F.col("neg") / n0, spread))
        .withColumn("odds", odds)
        .where((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_STEMS)
        .collect()
    )
    return {r["feature"]: float(r["odds"]) for r in rows}


def _feature_batches(stems: dict[str, float]):
    machine = grammar()  # made here, not by every task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in slices(batches):
            rows = [
                read_clauses(text or "", lexicon, machine)
                for text in batch.column("text").to_pylist()
            ]
            # the four numbers of the curve, then 1 where a clause matched
            values = pa.array([[*r, float(m)] for r, m in rows], pa.list_(pa.float64()))
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), values], names=[*kept, "features"]
            )

    return lean(run)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression with bias by Newton steps."""
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([1e-3] + [ridge] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, label 0 or 1) over ``docs`` (doc_id, text), from at most
    ``sample_rows`` of them."""
    sample = stage(labelled_sample(docs, labels, sample_rows), "toxic-sample")
    numbered = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text")
    families = numbered.mapInArrow(lean(_families), "doc_id long, label int, family long")
    # of near copies the one with the smallest id
    firsts = stage(
        families.groupBy("family", "label").agg(F.min("doc_id").alias("doc_id")), "toxic-once"
    )
    once = numbered.join(firsts.select("doc_id"), "doc_id", "left_semi")
    stems = _learn_stems(once)
    rows = (
        once.select("label", "text")
        .mapInArrow(_feature_batches(stems), "label int, features array<double>")
        .collect()  # at most sample_rows rows of six numbers
    )
    y = np.array([r["label"] for r in rows], np.float64)
    if len(set(y)) < 2:
        return ToxicityModel(stems)
    x = np.array([r["features"][:-1] for r in rows], np.float64)
    return ToxicityModel(stems, tuple(fit_curve(x, y)))


LONE_MARGIN = math.log(LONE_MOST / (1 - LONE_MOST))


def _probability(features: Column, model: ToxicityModel) -> Column:
    margin = F.lit(float(model.curve[0]))
    for i, weight in enumerate(model.curve[1:]):
        margin = margin + F.get(features, F.lit(i)) * float(weight)
    matched = F.get(features, F.lit(len(model.curve) - 1)) > 0
    margin = F.when(matched, margin).otherwise(F.least(margin, F.lit(LONE_MARGIN)))
    return 1 / (1 + F.exp(-margin))


def toxic_margin(text: str, model: ToxicityModel, lexicon: Lexicon, machine: Machine) -> float:
    """The margin of one text; its probability is the logistic curve of it."""
    features, matched = read_clauses(text, lexicon, machine)
    margin = model.curve[0] + sum(map(mul, model.curve[1:], features))
    return margin if matched else min(margin, LONE_MARGIN)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id and score, the probability that the text is toxic."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).mapInArrow(_feature_batches(model.stems), "doc_id long, features array<double>")
    return rows.select("doc_id", _probability(F.col("features"), model).alias("score"))


def drop_toxic(
    docs: DataFrame, model: ToxicityModel, *, text: str = "text", reject_from: float = 0.3
) -> DataFrame:
    """The rows of ``docs`` with a score below ``reject_from``, as they are."""

    names, schema, machine = docs.columns, docs.schema, grammar()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.stems)
        for batch in slices(batches, text):
            margins = [
                toxic_margin(t or "", model, lexicon, machine)
                for t in batch.column(text).to_pylist()
            ]
            clean = [1 / (1 + math.exp(-min(max(m, -500), 500))) < reject_from for m in margins]
            yield batch.filter(pa.array(clean, pa.bool_())).select(names)

    return docs.mapInArrow(lean(keep), schema)
