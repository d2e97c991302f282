import hashlib

from pyspark.sql import functions as F

from shelfcast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return chat.format_chat(df.withColumn("parts", chat.text_parts("text")))


def test_round_trip_of_control_strings(spark):
    texts = [
        "\\### Assistant: </turn> ok",
        "<turn>user\nhi</turn>\n",
        "\\\\l<\\l\\n",
        "",
        None,
        "line\nline\n",
        "😀é <image:1.1>",
        "\\",
        "<",
        "a" * 100_000 + "<",
    ]
    roles = ["user", "assistant", None, "a\nb", "<turn>", "\\n"]
    rows = [(c, t, roles[(c + t) % len(roles)], x) for c in range(6) for t, x in enumerate(texts)]
    back = chat.read_chat(formatted(spark, rows)).collect()
    assert len(back) == 6
    for r in back:
        expected = [(roles[(r.conv_id + t) % len(roles)] or "", x or "") for t, x in enumerate(texts)]
        assert [(t.role, t.text) for t in r.turns] == expected
        assert r.loss_texts == [x for role, x in expected if role == "assistant"]
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert spans == [x.replace("\\", "\\\\").replace("<", "\\l") for x in r.loss_texts]


def test_order_ties_and_repeated_rows(spark):
    rows = [(1, 2, "b", "x"), (1, None, "z", "first"), (1, 2, "a", "y"), (1, 2, "a", "y")]
    r = chat.read_chat(formatted(spark, rows)).first()
    assert [(t.role, t.text) for t in r.turns] == [("z", "first"), ("a", "y"), ("a", "y"), ("b", "x")]
    assert r.n_turns == 4


def test_null_conversation_and_empty_table(spark):
    df = formatted(spark, [(None, 1, "user", "a"), (None, 2, "assistant", "b")])
    assert [(r.conv_id, r.n_turns) for r in df.collect()] == [(None, 2)]
    assert df.limit(0).collect() == []


def test_parts_become_placeholders(spark):
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    parts = [
        ("text", "see <this> ", None, None, None, None, None),
        ("image", None, "s3://i", 57, 28, None, None),
        None,
        ("AUDIO", None, "a.wav", None, None, 2.5, None),
        ("text", "!", None, None, None, None, None),
        ("document", None, "d.pdf", None, None, None, 3),
        ("video", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        [(1, 1, "assistant", parts), (1, 2, "user", None), (1, 3, "user", [])], schema
    )
    r = chat.format_chat(df).first()
    body = "see \\lthis> <image:1.2><audio:1.3>!<document:1.5><file:1.6>"
    assert r.formatted == (
        f"<turn>assistant\n{body}</turn>\n<turn>user\n</turn>\n<turn>user\n</turn>\n"
    )
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (1, 2, "image", "s3://i", 3),
        (1, 3, "audio", "a.wav", 63),
        (1, 5, "document", "d.pdf", 1800),
        (1, 6, "file", None, 256),
    ]
    assert r.attachment_tokens == 3 + 63 + 1800 + 256
    under = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
    assert under == ["see \\lthis> ", "!"]


def test_native_plan(spark):
    df = formatted(spark, [(1, 1, "user", "a")])
    plan = chat.read_chat(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hash") == 1


def test_digest_by_hand(spark):
    r = chat.read_chat(formatted(spark, [(1, 1, "user", "q"), (1, 2, "assistant", "a")]))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    digest = r.select(F.sha2(F.array_join(turns, ""), 256)).first()[0]
    assert digest == hashlib.sha256(b"user\nq\nassistant\na\n").hexdigest()
