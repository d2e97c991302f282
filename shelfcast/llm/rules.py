r"""Quality rules: counted base rules and a calibrated logistic regression on hashed n-grams.

Base rules count words, their characters, symbols, repeated lines and words in repeated
three-word windows (told apart by a digest of 64 bits; that two of a text share one by chance
is not looked for). The verdict on what they let pass is that of a logistic regression over
hashed words, pairs of words and sequences of three and five characters (code points), as shares
of the text. It is trained on labelled rows, its margin is calibrated to a probability on rows
held out of the training, and texts below a fixed probability are rejected.

Semantics: words are runs of ``[^\x20\x09-\x0D]``; a null or empty text has none and fails the
base rules. The result depends on the text alone, so repeated rows get the same. Without
labels of both kinds only the base rules decide (probability 1). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_bucket, labelled_sample, lean, slices, within_bytes

# The base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3

# Documented parameters: training rows, hash space, training, fixed probability to keep.
SAMPLE_ROWS, SAMPLE_BYTES = 4_000, 24 * 1024 * 1024
HASH_BITS = 16
PASSES, RATE, RIDGE = 150, 0.05, 1e-6
KEEP_FROM = 0.3
KNOWN_WORDS = 100_000
BLOCK_ROWS = 1_024
# Shares are small numbers; this brings margins into a useful range.
SCALE = 40.0

_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        digest = self[word] = xxhash.xxh3_64_intdigest(word)
        return digest


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def word_digests(words: list[bytes], known: _Words) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def base_counts(text: str, data: bytes, words: list[bytes], digests: np.ndarray) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    in_words = sum(map(len, words))
    word_chars = len(text) - (len(data) - in_words)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated_lines = len(lines) - len(set(lines))
    repeated = 0
    if len(words) >= WINDOW:
        count = len(words) - WINDOW + 1
        windows = np.zeros(count, np.uint64)
        for i in range(WINDOW):
            windows = _mixed(windows ^ digests[i : i + count])
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.concatenate([times[inverse] > 1, np.zeros(WINDOW - 1, bool)])
        covered = twice.copy()
        for i in range(1, WINDOW):
            covered[i:] |= twice[:-i]
        repeated = int(covered.sum())
    return len(words), word_chars, symbols, repeated_lines, repeated


def ngram_slots(text: str, digests: np.ndarray) -> list[np.ndarray]:
    """Slots of the hashed n-grams by family: words, pairs of words, three and five characters."""
    drop = np.uint64(64 - HASH_BITS)
    space = 1 << HASH_BITS
    families = [(_mixed(digests) >> drop).astype(np.int32)]
    pairs = _mixed(_mixed(digests[:-1]) ^ digests[1:])
    # a word after itself is one n-gram, whatever the word
    pairs[digests[:-1] == digests[1:]] = np.uint64(1)
    families.append((pairs >> drop).astype(np.int32) + space)
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    for place, length in enumerate((3, 5), 2):
        count = max(len(letters) - length + 1, 0)
        # three code points of 21 bits fill a word; further ones are mixed in
        code = np.zeros(count, np.uint64)
        for i in range(length):
            code = (_mixed(code) if i == 3 else code << np.uint64(21)) ^ letters[i : i + count]
        families.append((_mixed(code) >> drop).astype(np.int32) + place * space)
    return families


def _prepared(batch: pa.RecordBatch, known: _Words) -> Iterator[tuple]:
    for text in batch.column("text").to_pylist():
        text = text or ""
        data = text.encode()
        words = data.split()
        yield text, data, words, word_digests(words, known)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Words()
    for batch in slices(batches):
        slots, shares = [], []
        for text, _, _, digests in _prepared(batch, known):
            own_slots, own_shares = [], []
            for family in ngram_slots(text, digests):
                slot, times = np.unique(family, return_counts=True)
                own_slots.append(slot)
                own_shares.append((SCALE * times / max(len(family), 1)).astype(np.float32))
            slots.append(np.concatenate(own_slots))
            shares.append(np.concatenate(own_shares))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                batch.column("held"),
                pa.array(slots, pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
            ],
            names=["doc_id", "label", "held", "slots", "shares"],
        )


@dataclass(frozen=True)
class RuleModel:
    """Weights by slot, bias, and slope and intercept of the calibration; None: no verdict."""

    weights: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def probability(self, text: str, digests: np.ndarray) -> float:
        if self.weights is None:
            return 1.0
        margin = self.bias
        for family in ngram_slots(text, digests):
            if len(family):
                margin += SCALE * float(self.weights[family].mean(dtype=np.float64))
        calibrated = self.slope * margin + self.intercept
        return float(1 / (1 + np.exp(-np.clip(calibrated, -500, 500))))


@dataclass(frozen=True)
class _Rows:
    """Slots and shares of the training rows one after the other, and where each row begins."""

    slots: np.ndarray
    shares: np.ndarray
    offsets: np.ndarray

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, their slots and shares, and the row of each: some rows at a time, so that what
        is computed of them stays small."""
        for at in range(0, len(self.offsets) - 1, BLOCK_ROWS):
            ends = self.offsets[at : at + BLOCK_ROWS + 1]
            inside = slice(ends[0], ends[-1])
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            yield slice(at, at + len(ends) - 1), self.slots[inside], self.shares[inside], row

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [
                np.bincount(row, share * weights[slot], part.stop - part.start)
                for part, slot, share, row in self.blocks()
            ]
        )


def _fit_weights(rows: _Rows, y: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the sparse rows of ``learn``; both labels weigh the same."""
    share_1, share_0 = 0.5 / max(y[learn].sum(), 1), 0.5 / max((1 - y[learn]).sum(), 1)
    weight = np.where(learn, np.where(y == 1, share_1, share_0), 0.0)
    size = 4 << HASH_BITS
    w, bias = np.zeros(size, np.float32), 0.0
    m, v = np.zeros(size), np.zeros(size)
    mb = vb = 0.0
    for step in range(1, PASSES + 1):
        g, gb = RIDGE * w.astype(np.float64), 0.0
        for part, slot, share, row in rows.blocks():
            margin = np.bincount(row, share * w[slot], part.stop - part.start) + bias
            error = weight[part] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part])
            g += np.bincount(slot, share * error[row], size)
            gb += float(error.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        mb += 0.1 * (gb - mb)
        vb += 0.01 * (gb * gb - vb)
        up, low = 1 - 0.9**step, 1 - 0.99**step
        w -= (RATE * (m / up) / (np.sqrt(v / low) + 1e-8)).astype(np.float32)
        bias -= RATE * (mb / up) / (np.sqrt(vb / low) + 1e-8)
    return w, bias


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a light ridge. Counts are
    smoothed by one row of each label, so that separable rows give no step."""
    n1, n0 = y.sum(), len(y) - y.sum()
    soft = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([margin, np.ones_like(margin)], 1)
    w = np.array([1.0, 0.0])
    penalty = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        change = np.linalg.solve(hessian, design.T @ (p - soft) + penalty @ w)
        w -= np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> RuleModel:
    """Train on ``labels`` (doc_id, label 0 or 1) over ``docs`` (doc_id, text): on at most
    ``sample_rows`` rows and ``sample_bytes`` bytes of whole texts. Their n-grams are hashed on
    the executors; slots and shares come to the driver. A quarter of the rows calibrates."""
    sample = within_bytes(labelled_sample(docs, labels, sample_rows), sample_bytes).select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        (crc_bucket("doc_id", 4) == 0).alias("held"),
        "text",
    )
    table = (
        sample.mapInArrow(
            lean(_training_rows),
            "doc_id long, label int, held boolean, slots array<int>, shares array<float>",
        )
        .toArrow()
        .sort_by("doc_id")
        .combine_chunks()
    )
    y = table["label"].to_numpy().astype(np.float64)
    held = table["held"].to_numpy()
    if len(set(y[~held])) < 2:
        return RuleModel()
    slots, shares = (table[c].combine_chunks() for c in ("slots", "shares"))
    rows = _Rows(slots.values.to_numpy(), shares.values.to_numpy(), slots.offsets.to_numpy())
    weights, bias = _fit_weights(rows, y, ~held)
    test = held if len(set(y[held])) == 2 else ~held
    margin = rows.margins(weights) + bias
    return RuleModel(weights, bias, *_calibrate(margin[test], y[test]))


def _scorer(model: RuleModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for batch in slices(batches):
            counts, probabilities = [], []
            for text, data, words, digests in _prepared(batch, known):
                counts.append(base_counts(text, data, words, digests))
                probabilities.append(model.probability(text, digests))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(probabilities, pa.float64())],
                names=["doc_id", *names, "probability"],
            )

    return lean(run)


def apply_rules(
    docs: DataFrame,
    model: RuleModel,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, probability and kept."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = named.mapInArrow(
        _scorer(model),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, probability double",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= keep_from)
    )
