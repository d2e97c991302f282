"""Quality classifier: a small convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of its bytes. Bytes are embedded, learned
filters run over every position of a chunk, and each filter keeps its maximum. A hidden layer
reads the maxima of a chunk; mean and maximum of it over all chunks give one probability. What
repeats a few words fires few filters, what is noise fires others, so both show.

The network is trained here, with Adam on all chunks of labelled texts of a sample that is
bounded in rows and bytes. Scoring reads whole texts, a block of chunks at a time.

Scores come from weights on binary grids, coarse enough that every product and partial sum is
a number the machine holds exactly. Sums then do not depend on their order, so neither the
batch, the partition nor the library of matrix products shows in a score.

Semantics: a null or empty text is one chunk of padding. The score depends on the text alone,
so repeated rows score alike, to the last bit. Without labels of both kinds the score is the
share of label 1 (0.5 without labels). Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import labelled_sample, lean, slices, within_bytes

# Documented parameters.
SAMPLE_ROWS, SAMPLE_BYTES = 4_000, 32 * 1024 * 1024
CHUNK, HOP = 512, 448
EMBEDDING, WIDTH, FILTERS, HIDDEN = 8, 6, 24, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 8, 32, 0.01, 1e-5, 3
PAD = 256
BLOCK = 64
# Grids of the weights when scoring: those of the filters follow from what 24 bits hold.
EMBED_UNIT, HIDDEN_UNIT, LAYER_UNIT = 2.0**-8, 2.0**-16, 2.0**-20


def on_grid(values: np.ndarray, unit: float) -> np.ndarray:
    return np.round(np.asarray(values, np.float64) / unit) * unit


def chunks_of(text: bytes, most: int | None = None) -> np.ndarray:
    """Overlapping chunks of the bytes, the last one padded."""
    data = np.frombuffer(text, np.uint8).astype(np.int16)
    count = 1 if len(data) <= CHUNK else 1 + -(-(len(data) - CHUNK) // HOP)
    padded = np.full(CHUNK + (count - 1) * HOP, PAD, np.int16)
    padded[: len(data)] = data
    chunks = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::HOP]
    if most is not None and count > most:
        chunks = chunks[np.linspace(0, count - 1, most).astype(int)]
    return chunks


@dataclass
class Network:
    embed: np.ndarray  # 257 x EMBEDDING
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    filter_bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # 2 * HIDDEN
    out_bias: np.ndarray

    @staticmethod
    def fresh(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, fan: int) -> np.ndarray:
            return (rng.normal(size=shape) / np.sqrt(fan)).astype(np.float32)

        return Network(
            normal(PAD + 1, EMBEDDING, fan=2),
            normal(WIDTH * EMBEDDING, FILTERS, fan=WIDTH * EMBEDDING),
            np.zeros(FILTERS, np.float32),
            normal(FILTERS, HIDDEN, fan=FILTERS),
            np.zeros(HIDDEN, np.float32),
            normal(2 * HIDDEN, fan=2 * HIDDEN),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [
            self.embed,
            self.filters,
            self.filter_bias,
            self.hidden,
            self.hidden_bias,
            self.out,
            self.out_bias,
        ]

    def maxima(self, chunks: np.ndarray, where: bool = False):
        """Largest response of each filter in each chunk, and its position if asked for."""
        found, places = [], []
        for at in range(0, len(chunks), BLOCK):
            embedded = self.embed[chunks[at : at + BLOCK]].reshape(-1, CHUNK * EMBEDDING)
            windows = np.lib.stride_tricks.sliding_window_view(
                embedded, WIDTH * EMBEDDING, axis=1
            )[:, ::EMBEDDING]
            response = windows.reshape(-1, WIDTH * EMBEDDING) @ self.filters
            response = response.reshape(len(embedded), -1, FILTERS)
            if where:
                places.append(response.argmax(axis=1))
            found.append(response.max(axis=1) + self.filter_bias)
        maxima = np.maximum(np.concatenate(found), 0)
        return (maxima, np.concatenate(places)) if where else maxima

    def combine(self, maxima: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hidden layer, its mean and maximum per text, and the margin."""
        layer = np.maximum(maxima @ self.hidden + self.hidden_bias, 0)
        counts = np.diff(np.append(starts, len(maxima)))
        mean = np.add.reduceat(layer, starts) / counts[:, None]
        most = np.maximum.reduceat(layer, starts)
        pooled = np.hstack([mean, most])
        return layer, counts, pooled, pooled @ self.out + self.out_bias

    def exact(self) -> Network:
        """The network with weights on grids: the responses of the filters are exact in single
        precision (24 bits), the hidden layer in double precision (53 bits)."""
        embed = on_grid(self.embed, EMBED_UNIT)
        largest = np.tile(np.abs(embed).max(axis=0), WIDTH)
        bound = float((largest[:, None] * (np.abs(self.filters) + 2.0**-8)).sum(axis=0).max())
        unit = min(2.0 ** math.ceil(math.log2(bound / EMBED_UNIT / 2.0**23)), 2.0**-8)
        single = np.float32
        return Network(
            embed.astype(single),
            on_grid(self.filters, unit).astype(single),
            on_grid(self.filter_bias, HIDDEN_UNIT),
            on_grid(self.hidden, HIDDEN_UNIT),
            on_grid(self.hidden_bias, HIDDEN_UNIT),
            self.out.astype(np.float64),
            self.out_bias.astype(np.float64),
        )

    def layer(self, chunks: np.ndarray) -> np.ndarray:
        """Hidden layer of each chunk, rounded to a grid on which sums over chunks are exact."""
        maxima = self.maxima(chunks).astype(np.float64)
        return np.maximum(on_grid(maxima @ self.hidden + self.hidden_bias, LAYER_UNIT), 0)

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Margin of each text; the same whatever texts stand beside it."""
        exact = self.exact()
        # of every text: number of chunks, sum and maximum of the hidden layer
        counts = np.zeros(len(texts))
        sums, tops = np.zeros((len(texts), HIDDEN)), np.zeros((len(texts), HIDDEN))
        pending: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            layer = exact.layer(np.concatenate([part for _, part in pending]))
            at = 0
            for text, part in pending:
                own = layer[at : at + len(part)]
                at += len(part)
                counts[text] += len(part)
                sums[text] += own.sum(axis=0)
                tops[text] = np.maximum(tops[text], own.max(axis=0))
            pending.clear()

        for i, text in enumerate(texts):
            own = chunks_of(text)
            for at in range(0, len(own), 16 * BLOCK):
                pending.append((i, own[at : at + 16 * BLOCK]))
                if sum(len(part) for _, part in pending) >= 16 * BLOCK:
                    flush()
        if pending:
            flush()
        pooled = np.hstack([sums / counts[:, None], tops]) if texts else np.zeros((0, 2 * HIDDEN))
        # term by term: every text adds up in the same order
        margin = np.full(len(texts), exact.out_bias[0])
        for j in range(2 * HIDDEN):
            margin += pooled[:, j] * exact.out[j]
        return margin


def _gradients(net: Network, chunks: np.ndarray, starts: np.ndarray, y: np.ndarray) -> list:
    maxima, places = net.maxima(chunks, where=True)
    layer, counts, pooled, margin = net.combine(maxima, starts)
    error = (1 / (1 + np.exp(-margin)) - y).astype(np.float32) / len(y)
    d_pooled = error[:, None] * net.out
    text = np.repeat(np.arange(len(y)), counts)
    d_layer = (d_pooled[:, :HIDDEN] / counts[:, None])[text]
    top = layer == pooled[text, HIDDEN:]
    ties = np.add.reduceat(top.astype(np.float32), starts)
    d_layer = d_layer + top * (d_pooled[:, HIDDEN:] / np.maximum(ties, 1))[text]
    d_layer = d_layer * (layer > 0)
    d_maxima = (d_layer @ net.hidden.T) * (maxima > 0)
    d_embed, d_filters = np.zeros_like(net.embed), np.zeros_like(net.filters)
    for at in range(0, len(chunks), 16 * BLOCK):
        part = slice(at, at + 16 * BLOCK)
        # only the window of the maximum of a filter takes part in its gradient
        windows = places[part, :, None] + np.arange(WIDTH)
        codes = np.take_along_axis(chunks[part, None, :], windows, axis=2)
        inputs = net.embed[codes].reshape(len(codes), FILTERS, -1)
        d_filters += np.einsum("cf,cfk->kf", d_maxima[part], inputs)
        d_inputs = (d_maxima[part, :, None] * net.filters.T).reshape(-1, EMBEDDING)
        flat = codes.reshape(-1)
        for e in range(EMBEDDING):
            d_embed[:, e] += np.bincount(flat, d_inputs[:, e], PAD + 1)
    return [
        d_embed,
        d_filters,
        d_maxima.sum(axis=0),
        maxima.T @ d_layer,
        d_layer.sum(axis=0),
        pooled.T @ error,
        np.array([error.sum()], np.float32),
    ]


def train(texts: list[bytes], labels: np.ndarray, seed: int = SEED) -> Network:
    """Adam over ``EPOCHS`` passes in an order that depends on ``seed`` alone."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed + 1)
    cut = [chunks_of(text) for text in texts]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    steps = EPOCHS * -(-len(texts) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            counts = [len(cut[i]) for i in rows]
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            step += 1
            rate = RATE * (1 - 0.95 * step / steps)
            gradients = _gradients(net, np.concatenate([cut[i] for i in rows]), starts, labels[rows])
            for p, g, m, v in zip(net.parameters(), gradients, first, second, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


@dataclass(frozen=True)
class QualityModel:
    network: Network | None
    share: float = 0.5


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> QualityModel:
    """Train on ``labels`` (doc_id, label 0 or 1) over ``docs`` (doc_id, text): on at most
    ``sample_rows`` rows and ``sample_bytes`` bytes of whole texts, which come to the driver."""
    sample = within_bytes(labelled_sample(docs, labels, sample_rows), sample_bytes)
    rows = sample.toPandas().sort_values("doc_id")
    y = rows["label"].to_numpy(np.float32)
    if len(set(y)) < 2:
        return QualityModel(None, float(y.mean()) if len(y) else 0.5)
    return QualityModel(train([t.encode() for t in rows["text"]], y), float(y.mean()))


def _scorer(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            if not texts:
                continue
            if model.network is None:
                scores = np.full(len(texts), model.share)
            else:
                margins = np.clip(model.network.margins(texts), -500, 500)
                scores = [1 / (1 + math.exp(-margin)) for margin in margins.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return lean(run)


def score_quality(
    docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id and score, the probability of label 1."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(_scorer(model), "doc_id long, score double")
