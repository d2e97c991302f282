r"""Chat formatting of messages with typed content parts.

A message is an array of parts: text, image, audio or document. A visitor flattens them in
order: text is escaped, an attachment becomes a placeholder such as ``<image:2.1>`` (turn and
part), its reference is recorded, and its cost in tokens is counted. A turn reads

    <turn>ROLE
    BODY</turn>

Texts and roles cannot forge the template: ``\`` becomes ``\\`` and ``<`` becomes ``\l`` (in
roles also a line break becomes ``\n``), so no control string survives in them and every
text comes back exactly.

Semantics: a null text, role or part list is empty; a null part is skipped; an unknown kind
of part is an attachment of the kind "file". Turns are ordered by number (nulls first), ties
by role and parts; repeated rows are repeated turns; rows without a conversation form one of
their own. Only the named columns are read. A conversation is one output row, so it has to
fit a task, as any row does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template.
OPEN, CLOSE = "<turn>", "</turn>\n"
LOSS_ROLE = "assistant"

# Documented parameters: pixels of an image tile, tokens per second, page and unknown file.
TILE, AUDIO_RATE, PAGE_TOKENS, FILE_TOKENS = 28, 25, 600, 256

PART = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)


def text_parts(text: Column | str) -> Column:
    """A plain text as a message of one text part."""
    text = F.col(text) if isinstance(text, str) else text
    part = F.struct(
        F.lit("text").alias("kind"),
        text.alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Left to right: cut at escaped backslashes, so what is left of them are other escapes."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(pieces, lambda p: F.replace(p, F.lit("\\l"), F.lit("<")))
    return F.array_join(plain, "\\")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    pieces = F.split(role, r"\\\\")
    plain = F.transform(
        pieces,
        lambda p: F.replace(
            F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")
        ),
    )
    return F.array_join(plain, "\\")


def _kind(part: Column) -> Column:
    known = F.lower(part["kind"])
    return F.when(known.isin("text", "image", "audio", "document"), known).otherwise("file")


def _part_tokens(part: Column) -> Column:
    """What an attachment expands to: tiles of an image, time of a sound, pages of a document."""
    kind = _kind(part)
    tiles = F.ceil(F.coalesce(part["width"], F.lit(TILE)) / TILE) * F.ceil(
        F.coalesce(part["height"], F.lit(TILE)) / TILE
    )
    return (
        F.when(kind == "image", tiles)
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
        .otherwise(FILE_TOKENS)
        .cast("long")
    )


def _visit(part: Column, turn: Column, number: Column) -> Column:
    """A part as what stands in the body for it."""
    kind = _kind(part)
    mark = F.concat(
        F.lit("<"),
        kind,
        F.lit(":"),
        turn.cast("string"),
        F.lit("."),
        (number + 1).cast("string"),
        F.lit(">"),
    )
    return F.struct(
        (kind == "text").alias("is_text"),
        F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark).alias(
            "body"
        ),
        F.when(
            kind != "text",
            F.struct(
                turn.alias("turn"),
                (number + 1).alias("part"),
                kind.alias("kind"),
                part["ref"].alias("ref"),
                _part_tokens(part).alias("tokens"),
            ),
        ).alias("attachment"),
    )


def format_chat(
    messages: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (turn from 1, start and length
    in the formatted string, both in code points, and offset from the start of the turn),
    attachments in order, attachment_tokens, n_turns."""
    rows = messages.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.filter(
            F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")),
            lambda p: p.isNotNull(),
        ).alias("_parts"),
    )
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_parts")
    rows = rows.withColumn("_n", F.row_number().over(order)).withColumn(
        "_visited", F.transform("_parts", lambda p, i: _visit(p, F.col("_n"), i))
    )
    head = F.concat(F.lit(OPEN), _escape_role(F.col("_role")), F.lit("\n"))
    rows = rows.withColumn("_bodies", F.col("_visited.body")).select(
        "conv_id",
        "_n",
        F.concat(head, F.array_join("_bodies", ""), F.lit(CLOSE)).alias("_text"),
        F.when(
            F.col("_role") == loss_role,
            F.filter(
                F.transform(
                    "_visited",
                    lambda v, i: F.struct(
                        v["is_text"].alias("is_text"),
                        (
                            F.length(head)
                            + F.length(F.array_join(F.slice("_bodies", 1, i), ""))
                        ).alias("offset"),
                        F.length(v["body"]).alias("length"),
                    ),
                ),
                lambda s: s["is_text"],
            ),
        ).alias("_spans"),
        F.array_compact("_visited.attachment").alias("_attached"),
    )
    before = Window.partitionBy("conv_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(
        "_start", F.coalesce(F.sum(F.length("_text")).over(before), F.lit(0))
    ).withColumn(
        "_spans",
        F.transform(
            "_spans",
            lambda s: F.struct(
                F.col("_n").alias("turn"),
                (F.col("_start") + s["offset"]).alias("start"),
                s["length"].alias("length"),
                s["offset"].alias("offset"),
            ),
        ),
    )
    turns = F.sort_array(F.collect_list(F.struct("_n", "_text", "_spans", "_attached")))
    grouped = rows.groupBy("conv_id").agg(turns.alias("_turns"))
    return grouped.select(
        "conv_id",
        F.array_join("_turns._text", "").alias("formatted"),
        F.flatten(F.array_compact("_turns._spans")).alias("loss_spans"),
        F.flatten("_turns._attached").alias("attachments"),
        F.aggregate(
            F.flatten("_turns._attached"), F.lit(0).cast("long"), lambda n, a: n + a["tokens"]
        ).alias("attachment_tokens"),
        F.size("_turns").cast("long").alias("n_turns"),
    )


def read_chat(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) and the loss texts read back from ``formatted`` and its spans.
    Placeholders stay in the text of a turn as they stand in the body."""
    pieces = F.split("formatted", OPEN)
    turns = F.slice(pieces, 2, F.size(pieces))

    def read(turn: Column) -> Column:
        role = F.substring_index(turn, "\n", 1)
        body = F.substring(
            turn,
            F.length(role) + 2,
            F.length(turn) - F.length(role) - 1 - F.lit(len(CLOSE)),
        )
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    def under_mask(span: Column) -> Column:
        turn = F.get(F.col("_raw"), span["turn"] - 1)
        start = span["offset"] - len(OPEN) + 1
        return unescape(F.substring(turn, start, span["length"]))

    return (
        formatted.withColumn("_raw", turns)
        .withColumn("turns", F.transform("_raw", read))
        .withColumn("loss_texts", F.transform("loss_spans", under_mask))
        .drop("_raw")
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), texts AS (
  SELECT conv_id,
         count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<turn>') + length(replace(replace(replace(role, '\', '\\'), '<', '\l'),
                                               chr(10), '\n'))
             + 1 + length(replace(replace(text, '\', '\\'), '<', '\l'))
             + length('</turn>') + 1) AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256,
       length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM texts
"""
