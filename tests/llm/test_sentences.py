import io
import random
from pathlib import Path

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import decoders

from shelfcast.llm import sentences as S

pytestmark = pytest.mark.skipif(not Path(S.MODEL).exists(), reason="needs the model file")
ODD = [
    "", "  a  b", "\n\n", "▁", "a▁ b", "<s> hi </s> <unk> <0x41>", "😀é\u0000x", "   ", "日本語テキスト",
    "a" * 5000, "ab " * 3000, "\t\tint main() {\n    return 0;\n}", "aaaaabbbbb    cccc", "------====", "..." * 40,
]


def random_texts(n=1500):
    rng = random.Random(1)
    return ["".join(rng.choice("ab ceth▁\n.é😀012") for _ in range(rng.randrange(60))) for _ in range(n)]


def test_parity_of_the_merge_model():
    data = Path(S.MODEL).read_bytes()
    model = S.parse_model(data)
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [p[0] for p in model.pieces] == [processor.id_to_piece(i) for i in range(len(model.pieces))]
    encoder, texts = S.Encoder(model), ODD + random_texts()
    assert encoder.encode(texts) == processor.encode(texts)
    assert encoder.encode(texts) == processor.encode(texts)  # from remembered words
    assert all(len(w) <= S.LONG_WORD for w in encoder.known)


def message(number, payload):
    """A length-delimited field of a protobuf message."""
    size, out = len(payload), bytes([number << 3 | 2])
    while size > 127:
        out += bytes([size & 127 | 128])
        size >>= 7
    return out + bytes([size]) + payload


def unigram_model():
    """A small unigram model file written by hand: pieces, scores, kinds, byte fallback."""
    import struct

    pieces = [("<unk>", 0.0, S.UNKNOWN)]
    pieces += [(f"<0x{b:02X}>", 0.0, S.BYTE) for b in range(256)]
    words = {"▁": -2.0, "▁a": -3.0, "a": -4.0, "b": -4.1, "ab": -5.0, "▁ab": -4.5, "abb": -6.5, "c": -5.5}
    pieces += [(w, s, S.NORMAL) for w, s in words.items()]
    out = io.BytesIO()
    for piece, score, kind in pieces:
        body = message(1, piece.encode()) + b"\x15" + struct.pack("<f", score) + bytes([0x18, kind])
        out.write(message(1, body))
    out.write(message(2, bytes([0x18, 1]) + b"\x98\x02\x01"))  # unigram, byte fallback
    out.write(message(3, bytes([0x18, 1, 0x20, 0, 0x28, 1])))
    return out.getvalue()


def test_parity_of_a_unigram_model():
    data = unigram_model()
    model = S.parse_model(data)
    assert (model.kind, model.byte_fallback, model.dummy_prefix, model.collapse_spaces) == (1, True, True, False)
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab abb c", "a", "abbabc  a", "xyz", "é b", "cab abba"]
    assert S.Encoder(model).encode(texts) == processor.encode(texts)


def test_words_that_differ_are_noticed():
    data = Path(S.MODEL).read_bytes()
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    encoder = S.Encoder(S.parse_model(data), processor)
    texts = ["one two three", "four two", "five"]
    good = [S._packed(ids) for ids in processor.encode(texts)]
    assert encoder.encode_verified(texts, 1) == (good, [True] * 3, [True] * 3)
    # as if the tokenizer had a word wrong
    encoder.known["▁two"] = S._packed([1])
    encoder.other.add("▁two")
    ids, parity, _ = encoder.encode_verified(texts, 1)
    assert ids == good and parity == [False, False, True]


def test_every_text_is_compared_as_a_whole():
    data = Path(S.MODEL).read_bytes()
    encoder = S.Encoder(S.parse_model(data), sentencepiece.SentencePieceProcessor(model_proto=data))
    texts = [f"{word} two {i}" for i in range(40) for word in ("one", "four")]
    good, *_ = encoder.encode_verified(texts, 1)
    # a word that was verified and then went wrong, and a decoder that loses spaces
    encoder.known["▁two"] = S._packed([1])
    assert encoder.encode_verified(texts, 1) == (good, [False] * 80, [True] * 80)
    encoder.tokenizer.decoder = decoders.Fuse()
    assert encoder.encode_verified(texts, 1)[2] == [False] * 80


def test_documents(documents):
    texts = [*ODD, None]
    rows = [*enumerate(texts), (0, texts[0])]
    df = documents(rows)
    encoded = S.encode_documents(df)
    got = encoded.collect()
    assert len(got) == len(rows) and all(r.parity and r.round_trip for r in got)
    ids = {r.doc_id: r.ids for r in got}
    assert ids[len(texts) - 1] is None and ids[0] == []
    decoded = {r.doc_id: r.text for r in S.decode_documents(encoded).collect()}
    assert decoded == {i: None if t is None else t.replace("▁", " ") for i, t in enumerate(texts)}
    assert S.encode_documents(df.limit(0)).collect() == []


def test_broken_or_large_files(tmp_path, documents, monkeypatch):
    broken = tmp_path / "broken.model"
    broken.write_bytes(b"\xff\xff")
    with pytest.raises((ValueError, IndexError)):
        S.parse_model(broken.read_bytes())
    monkeypatch.setattr(S, "MAX_MODEL_BYTES", 1)
    with pytest.raises(ValueError, match="larger"):
        S.encode_documents(documents([(1, "a")]), model_path=str(broken))


def test_joined_words_and_split_texts_change_nothing():
    data = Path(S.MODEL).read_bytes()
    model = S.parse_model(data)
    encoder, alone = S.Encoder(model), S.Encoder(model)
    alone.joins = False
    texts = [*ODD, *random_texts(), " a", "a ", "a    b", "  ", "é  \n x"]
    for text in texts:
        assert encoder.cut(text) == encoder.words.findall(encoder.normalize(text))
    words = sorted({word for text in texts for word in encoder.cut(text)})
    given = []

    class Counting:
        def encode_batch_fast(self, batch, **options):
            given.extend(batch)
            return alone.tokenizer.encode_batch_fast(batch, **options)

    encoder.tokenizer = Counting()
    assert encoder.encode_new(words) == alone.encode_new(words)
    assert len(given) < len(words) / 4
    # where the pieces do not tell the ends of the words, each word is encoded on its own
    given.clear()
    encoder.piece_bytes = encoder.piece_bytes + 1
    assert encoder.encode_new(words) == alone.encode_new(words)
    assert set(words) <= set(given) | {"".join(words)}


def test_words_that_come_again_stay_remembered():
    encoder = S.Encoder(S.parse_model(Path(S.MODEL).read_bytes()), cached_words=2)
    encoder.encode(["one two three"])
    encoder.known["▁two"] = S._packed([1])  # as a sign that it is not encoded again
    assert encoder.encode(["two four"])[0][0] == 1
    assert set(encoder.known) == {"▁two", "▁four"}


def test_tasks_do_not_find_pieces_and_merges_anew(monkeypatch):
    data, texts = Path(S.MODEL).read_bytes(), ["one two", "", "三 x"]
    tasks = S._codec(data, 1, 10), S._decoder(data, 1)
    monkeypatch.setattr(S, "parse_model", None)
    monkeypatch.setattr(S, "merges", None)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts})
    (encoded,) = tasks[0](iter([batch]))
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert encoded.column("ids").to_pylist() == processor.encode(texts)
    (decoded,) = tasks[1](iter([encoded]))
    assert decoded.column("text").to_pylist() == texts


def test_markers_are_decoded_as_by_a_pattern():
    data = Path(S.MODEL).read_bytes()
    tokenizer = S.build_tokenizer(S.parse_model(data))
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(2)
    ids = [processor.encode(text) for text in [*ODD, *random_texts(300)]]
    ids += [[rng.randrange(len(processor)) for _ in range(rng.randrange(20))] for _ in range(300)]
    got = [tokenizer.decode(i, skip_special_tokens=False) for i in ids]
    tokenizer.decoder = decoders.Sequence(
        [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace("▁", " "), decoders.Strip(" ", 1, 0)]
    )
    assert got == [tokenizer.decode(i, skip_special_tokens=False) for i in ids]
