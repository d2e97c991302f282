"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf; its pieces, scores, kinds and normaliser are read field by field
and rebuilt as a tokenizer: the normaliser, the marker of spaces, a unigram or merge model and
byte fallback. A merge model stores no merges, only scores: every split of a piece into two
pieces is a merge, ordered by the score of the whole.

Pieces never cross from a character into a space marker if no piece of the model does; then
texts are cut there first, which changes no result, and each distinct word of a batch is
encoded once, many new ones as one string. The cut is made only for models where this holds.

Words are encoded in batches by several threads. Parity with the sentencepiece library and the
way back through the decoder are verified for every text as a whole, one text at a time, as
the tasks already keep the cores busy. Where the two libraries
differ the ids of sentencepiece are returned and the row says so; round_trip says whether the
ids decode to the normalised text.

Semantics: a null text has null ids and counts as parity and round trip; an empty one has no
ids. A space marker in a text reads as a space afterwards, as in the format itself.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import SLICE_BYTES, lean, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
THREADS = 2
# Ids of a large model are megabytes; what is shipped with a task must stay small.
MAX_MODEL_BYTES = 32 * 1024 * 1024
# Words remembered between batches, and the longest that are.
CACHED_WORDS, LONG_WORD = 400_000, 64
# Words encoded at a time, and as one string.
WORDS_AT_ONCE, JOINED_WORDS = 8_192, 64
DECODE_ROWS = 200

# Kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = varint(at)
        elif wire in (1, 5):
            width = 8 if wire == 1 else 4
            value, at = data[at : at + width], at + width
        elif wire == 2:
            length, at = varint(at)
            value, at = data[at : at + length], at + length
        else:
            raise ValueError(f"not a model file: wire type {wire}")
        yield number, value


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for part, content in _fields(value):
                if part == 1:
                    piece = content.decode("utf-8")
                elif part == 2:
                    score = struct.unpack("<f", content)[0]
                elif part == 3:
                    kind = content
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for part, content in _fields(value):
                if part == 3:
                    model.kind = content
                elif part == 35:
                    model.byte_fallback = bool(content)
        elif number == 3:
            for part, content in _fields(value):
                if part == 2:
                    model.charsmap = content
                elif part == 3:
                    model.dummy_prefix = bool(content)
                elif part == 4:
                    model.collapse_spaces = bool(content)
                elif part == 5:
                    model.escape_spaces = bool(content)
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first; equal scores in order of ids."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, score, kind in model.pieces:
        if kind != NORMAL:
            continue
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-score, ids[left], ids[right]))
    found.sort()
    # the strings of the pieces themselves, so that both together are shipped and held once
    return [(model.pieces[left][0], model.pieces[right][0]) for _, left, right in found]


def stays_in_words(model: Model) -> bool:
    """Whether no piece has a space marker behind another character."""
    return all(
        MARKER not in piece.lstrip(MARKER)
        for piece, _, kind in model.pieces
        if kind in (NORMAL, USER)
    )


def build_tokenizer(model: Model, pairs: list[tuple[str, str]] | None = None):
    """Normaliser, model and decoder of the model file as one tokenizer; ``pairs`` are its
    ``merges``, where they are known already."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind == UNIGRAM:
        scores = [(piece, score) for piece, score, _ in model.pieces]
        core = models.Unigram(scores, unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {piece: i for i, (piece, _, _) in enumerate(model.pieces)},
            merges(model) if pairs is None else pairs,
            unk_token=model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=0,  # the encoder remembers words itself
        )
    else:
        raise ValueError("only unigram and merge models are supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.collapse_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    # markers are replaced in the text as a whole, not piece by piece, and without a pattern
    spaces = decoders.Metaspace(MARKER, prepend_scheme="never")
    tokenizer.decoder = decoders.Sequence(
        [decoders.ByteFallback(), decoders.Fuse(), spaces, *strip]
    )
    return tokenizer


class Encoder:
    """Encodes lists of texts; distinct words go through the tokenizer once."""

    def __init__(
        self,
        model: Model,
        processor=None,
        cached_words: int = CACHED_WORDS,
        pairs: list[tuple[str, str]] | None = None,
    ):
        self.model, self.processor, self.cached_words = model, processor, cached_words
        self.tokenizer = build_tokenizer(model, pairs)
        self.normalizer = self.tokenizer.normalizer
        self.tokenizer.normalizer = None
        self.plain = model.escape_spaces and not (model.charsmap or model.collapse_spaces)
        self.prefix = MARKER if model.dummy_prefix else ""
        self.by_word = model.escape_spaces and stays_in_words(model)
        self.words = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+" if self.by_word else "(?s).+")
        self.splits = self.by_word and self.plain and model.dummy_prefix
        self.joins = self.by_word and model.kind == BPE and model.byte_fallback
        self.piece_bytes = np.array(
            [1 if kind == BYTE else len(piece.encode()) for piece, _, kind in model.pieces]
        )
        self.known: dict[str, bytes] = {}
        # words of texts of which the libraries disagree
        self.other: set[str] = set()

    def normalize(self, text: str) -> str:
        if self.plain and text:  # the same steps, without tracking positions
            return self.prefix + text.replace(" ", MARKER)
        return self.normalizer.normalize_str(text)

    def cut(self, text: str) -> list[str]:
        if self.splits and text and MARKER not in text:  # the same words, without a pattern
            marked = MARKER + text.replace(" ", f" {MARKER}")
            while f"{MARKER} {MARKER}" in marked:
                marked = marked.replace(f"{MARKER} {MARKER}", MARKER * 2)
            return marked.split(" ")
        return self.words.findall(self.normalize(text))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [_ids(p).tolist() for p in self.encode_words([self.cut(t) for t in texts])]

    def encode_words(self, cut: list[list[str]]) -> list[bytes]:
        """Packed ids of texts given as their words."""
        here = set(chain.from_iterable(cut))
        if len(self.known) > self.cached_words:
            # what these texts hold again is the likeliest to come once more
            self.known = {word: self.known[word] for word in here if word in self.known}
            self.other.clear()
        new = list(here.difference(self.known))
        for at in range(0, len(new), WORDS_AT_ONCE):
            words = new[at : at + WORDS_AT_ONCE]
            self.known.update(zip(words, self.encode_new(words), strict=True))
        packed = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]
        return packed

    def encode_new(self, words: list[str]) -> list[bytes]:
        """Packed ids of words as ``cut`` gives them. Words that begin with a marker and end
        without one keep their pieces apart, so many of them are encoded as one string; the
        bytes of the pieces tell where each ends. If an end lies within a piece, and for other
        words and models, each word is encoded on its own."""
        joined = [w for w in words if w[0] == MARKER != w[-1]] if self.joins else []
        together = self.encode_joined(joined) if joined else []
        if len(together) == len(words):
            return together
        found = dict(zip(joined, together, strict=True)) if together else {}
        rest = [w for w in words if w not in found]
        alone = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        found.update(zip(rest, (_packed(e.ids) for e in alone), strict=True))
        return [found[w] for w in words]

    def encode_joined(self, words: list[str]) -> list[bytes]:
        """Packed ids of words encoded as parts of longer strings; none if an end lies within
        a piece."""
        starts = range(0, len(words), JOINED_WORDS)
        texts = ["".join(words[at : at + JOINED_WORDS]) for at in starts]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable([e.ids for e in encoded])), np.int32)
        reached = np.cumsum(self.piece_bytes[ids])
        ends = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy(), dtype=np.int64)
        last = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or (reached[last] != ends).any():
            return []
        packed, cuts = ids.tobytes(), ((last + 1) * ids.itemsize).tolist()
        return list(map(packed.__getitem__, map(slice, [0, *cuts[:-1]], cuts)))

    def encode_verified(self, texts: list[str], _threads: int = 1) -> tuple[list, list, list]:
        """Packed ids, parity and round trip per text, each compared as a whole."""
        cut = [self.cut(text) for text in texts]
        packed = self.encode_words(cut)
        parity, round_trip = [], []
        # one library after the other, as each has tables that should stay in the cache
        references = [self.processor.encode(text, return_type="numpy") for text in texts]
        for text, reference in zip(texts, references, strict=True):
            back = self.tokenizer.decode(reference.tolist(), skip_special_tokens=False)
            if self.model.charsmap:
                wanted = self.processor.decode(reference)
            else:
                wanted = _expected(text, self.model)
            round_trip.append(back == wanted)
        for i, own in enumerate(map(np.ndarray.tobytes, references)):
            parity.append(packed[i] == own)
            if not parity[i]:
                self.other.update(cut[i])
                packed[i] = own
        return packed, parity, round_trip


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int32)


def _read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return data


def _with_merges(data: bytes) -> tuple[Model, list[tuple[str, str]] | None]:
    """The model and its merges, which tasks then need not find anew."""
    model = parse_model(data)
    return model, merges(model) if model.kind == BPE else None


def _expected(text: str, model: Model) -> str:
    """The text as decoding gives it back, where the normaliser has no character map."""
    if model.collapse_spaces:
        text = " ".join(part for part in text.split(" ") if part)
    return text.replace(MARKER, " ")


def _codec(data: bytes, threads: int, cached_words: int):
    model, pairs = _with_merges(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        encoder = Encoder(model, processor, cached_words, pairs)
        is_byte = np.array([p[2] == BYTE for p in model.pieces])
        gc.disable()  # millions of short lists, no cycles: collections would only look for some
        for batch in slices(batches, "text", SLICE_BYTES // 2):
            texts = batch.column("text").to_pylist()
            present = [t or "" for t in texts]
            packed, parity, round_trip = encoder.encode_verified(present, threads)
            ids = _ids(b"".join(packed))
            ends = np.cumsum([len(p) // ids.itemsize for p in packed])
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            bytes_before = np.concatenate([[0], np.cumsum(is_byte[ids])])
            missing = np.array([t is None for t in texts])
            starts = pa.array(offsets, pa.int32(), mask=np.append(missing, False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(starts, pa.array(ids, pa.int32())),
                    pa.array(np.diff(bytes_before[offsets]), pa.int64()),
                    pa.array(parity, pa.bool_()),
                    pa.array(round_trip, pa.bool_()),
                ],
                names=["doc_id", "ids", "n_bytes", "parity", "round_trip"],
            )
        gc.enable()

    return lean(run)


def encode_documents(
    docs: DataFrame,
    *,
    model_path: str = MODEL,
    doc_id: str = "doc_id",
    text: str = "text",
    threads: int = THREADS,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, n_bytes (ids of the byte fallback), parity and
    round_trip. The model is read on the driver and goes with the tasks. A task remembers
    ``cached_words`` words, some 250 bytes each: fewer take less memory and more time."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(
        _codec(_read_model(model_path), threads, cached_words),
        "doc_id long, ids array<int>, n_bytes long, parity boolean, round_trip boolean",
    )


def _rows_at_a_time(
    batches: Iterator[pa.RecordBatch], rows: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _decoder(data: bytes, threads: int):
    model, pairs = _with_merges(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        tokenizer = build_tokenizer(model, pairs)
        for batch in _rows_at_a_time(batches, DECODE_ROWS):
            ids = batch.column("ids").to_pylist()
            texts = tokenizer.decode_batch([i or [] for i in ids], skip_special_tokens=False)
            kept = [None if i is None else t for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.string())], names=["doc_id", "text"]
            )

    return lean(run)


def decode_documents(
    encoded: DataFrame, *, model_path: str = MODEL, threads: int = THREADS
) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(_read_model(model_path), threads), "doc_id long, text string"
    )
