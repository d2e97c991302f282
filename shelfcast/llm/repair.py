r"""Conversation structure repair by generalised LR parsing.

Roles must read as ``(s?(ua)+)?``. An LR automaton of that grammar runs over the rows of a
conversation with a graph-structured stack: every row may be kept, reroled or deleted, and rows
may be inserted before it, each at a cost; tops in the same state are merged to the one with
the least (cost, audit), where the audit spells the edits. Equal tops have equal futures, so
nothing cheaper is lost.

A long conversation is cut into blocks of rows. Each block is parsed from every top it can
begin with, on its own; the tables of tops that result are composed pair by pair like matrices.
So the parsing of one huge conversation is spread over tasks. What meets in one task per
conversation is what its result holds in one field anyway: a letter per row and top. The hash of
a repaired conversation reads its rows in order, one Arrow batch at a time.

Order: rows stand by turn, nulls first, then role, first 32 characters and SHA-256 of the text;
rows equal in all are interchangeable. They are placed by range partitioning on that order, so
a conversation may span tasks. Whether role and text were seen before is a minimum per
conversation, role and digest.

Semantics: a null role or text is one space. The initial of a role is its first character;
only rows whose initial is s, u or a can be kept. Rows with a null conversation id are one
conversation. Each row has one fault, the first of: blank, duplicate, truncated. A conversation
without rows has zeros, an empty audit and the hash of nothing. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import lean, slices
from shelfcast.sources.staging import stage

# Costs of the edits, and what counts as a character and an end of a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
VISIBLE, ENDS = r"[^\x20\x09-\x0D]", ".!?"
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}

# The grammar and its LR(0) automaton. PAIRS -> ASKED a; ASKED -> u | s u | PAIRS u; a
# conversation is nothing or PAIRS. States 0 to 3 are tops between rows, the others reduce.
START, SYSTEM, ASKED, PAIRS = range(4)
SHIFT = {(START, "s"): SYSTEM, (START, "u"): 4, (SYSTEM, "u"): 5, (ASKED, "a"): 6, (PAIRS, "u"): 7}
REDUCE = {4: (1, "ASKED"), 5: (2, "ASKED"), 6: (2, "PAIRS"), 7: (2, "ASKED")}
GOTO = {(START, "ASKED"): ASKED, (START, "PAIRS"): PAIRS}
ACCEPT = (START, PAIRS)

# Documented parameters: rows of a block (a power of two), patterns a task remembers.
BLOCK_BITS = 12
REMEMBERED = 20_000

Best = tuple[int, str]
Tops = dict[int, Best]


class Node:
    """A node of the stack: a state on top of another node."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


BOTTOM = Node(START, None)
# between rows every stack is one of these; all share the bottom
STACKS = {START: BOTTOM, **{top: Node(top, BOTTOM) for top in (SYSTEM, ASKED, PAIRS)}}


def shift(top: int, symbol: str) -> int | None:
    """The top after reading a symbol on the stack of ``top``, all reductions done."""
    state = SHIFT.get((top, symbol))
    if state is None:
        return None
    node = Node(state, STACKS[top])
    while node.state in REDUCE:
        length, left = REDUCE[node.state]
        base = node
        for _ in range(length):
            base = base.below
        node = Node(GOTO[base.state, left], base)
    return node.state


MOVES = {(top, c): after for top in STACKS for c in "sua" if (after := shift(top, c)) is not None}


def _merge(tops: Tops, top: int | None, cost: int, audit: str) -> bool:
    if top is None:
        return False
    found = tops.get(top)
    if found is None or (cost, audit) < found:
        tops[top] = (cost, audit)
        return True
    return False


def with_inserts(tops: Tops) -> Tops:
    """The tops reachable by inserting rows, too."""
    opened, todo = dict(tops), list(tops)
    while todo:
        top = todo.pop()
        cost, audit = opened[top]
        for symbol in NAMES:
            after = MOVES.get((top, symbol))
            if _merge(opened, after, cost + INSERT, audit + "I"):
                todo.append(after)
    return opened


def parse(initials: str, faults: str, start: int) -> Tops:
    """Best (cost, audit) per top after the rows, from the stack of ``start``."""
    tops: Tops = {start: (0, "")}
    for initial, fault in zip(initials, faults, strict=True):
        after: Tops = {}
        for top, (cost, audit) in with_inserts(tops).items():
            _merge(after, top, cost + DELETE, audit + "D")
            if fault in "bd":
                continue
            paid = cost + (TRUNCATED if fault == "t" else 0)
            _merge(after, MOVES.get((top, initial)), paid, audit + "K")
            for symbol in NAMES:
                _merge(after, MOVES.get((top, symbol)), paid + REROLE, audit + "R")
        tops = after
    return tops


def compose(first: dict[int, Tops], second: dict[int, Tops]) -> dict[int, Tops]:
    """The table of two blocks one after the other."""
    joined: dict[int, Tops] = {}
    for start, tops in first.items():
        own = joined[start] = {}
        for middle, (cost, audit) in tops.items():
            for top, (more, rest) in second[middle].items():
                _merge(own, top, cost + more, audit + rest)
    return joined


def compose_all(tables: list[dict[int, Tops]]) -> dict[int, Tops]:
    """Pair by pair, so that a letter is copied as often as there are levels."""
    while len(tables) > 1:
        pairs = [compose(a, b) for a, b in zip(tables[::2], tables[1::2], strict=False)]
        tables = pairs + tables[2 * len(pairs) :]
    return tables[0]


def cheapest(table: dict[int, Tops]) -> Best:
    """The best (cost, audit) of a whole conversation."""
    tops = with_inserts(table[START])
    return min(tops[top] for top in ACCEPT if top in tops)


EDIT = re.compile("I*[KRD]")


def pieces_of(audit: str, blocks: list[str]) -> list[tuple[int, str]]:
    """Of each block, given by its initials, the top it begins with and its part of the audit.
    What is inserted behind the last row belongs to the last block."""
    found, top, edits, done = [], START, EDIT.finditer(audit), 0
    for number, initials in enumerate(blocks):
        start, begin = top, done
        for initial in initials:
            edit = next(edits)
            done = edit.end()
            for letter in edit.group():
                top = _after(top, letter, initial)
        if number == len(blocks) - 1:
            done = len(audit)
        found.append((start, audit[begin:done]))
    return found


def _after(top: int, letter: str, initial: str) -> int:
    if letter == "D":
        return top
    return MOVES[top, initial if letter == "K" else _wanted(top)]


def _wanted(top: int) -> str:
    """What a reroled or inserted row has to be."""
    return "a" if top == ASKED else "u"


def illegal_pairs(initials: str) -> int:
    pairs = Counter(map("".join, zip(initials, initials[1:], strict=False)))
    return sum(n for pair, n in pairs.items() if pair not in LEGAL)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the damage of the contract, a null role or text
    as one space, and ``_copy``, which tells the copies of a row from each other."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *spelled)) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.withColumn("_kind", kind)
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("_kind") == 1, "")
            .when(F.col("_kind") == 2, F.translate(text, ENDS, ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
    )


def in_order(rows: DataFrame) -> DataFrame:
    """A stored table of ``rows`` (conv_id, turn, role, text) with their place in the order of
    conversations and turns (pos), block, digest, initial and faults of their own."""
    text = F.col("text")
    visible = F.regexp_replace(text, r"[\x20\x09-\x0D]+$", "")
    copy = F.col("_copy") if "_copy" in rows.columns else F.lit(0)
    keys = ["conv_id", "turn", "role", "_begin", "digest", "_id", "_copy"]
    numbered = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
        # tells equal rows apart, so that any number of them can be cut into ranges
        F.monotonically_increasing_id().alias("_id"),
        copy.alias("_copy"),
    ).withColumns({"_begin": F.substring(text, 1, 32), "digest": F.unhex(F.sha2(text, 256))})
    initial = F.substring("role", 1, 1)
    return stage(
        numbered.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            "digest",
            F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
            (~text.rlike(VISIBLE)).alias("blank"),
            (~F.substring(visible, -1, 1).isin(*ENDS)).alias("truncated"),
            F.monotonically_increasing_id().alias("pos"),
        )
        .withColumn("block", F.shiftright("pos", BLOCK_BITS)),
        "turns",
    )


def faults_of(turns: DataFrame) -> DataFrame:
    """Narrow rows (conv_id, turn, pos, block, initial, fault): b blank, d duplicate,
    t truncated or a point."""
    firsts = (
        turns.groupBy("conv_id", "role", "digest")
        .agg(F.min("pos").alias("pos"))
        .select("pos", F.lit(True).alias("first"))
    )
    fault = (
        F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("truncated"), "t")
    )
    rows = turns.select("conv_id", "turn", "pos", "block", "initial", "blank", "truncated")
    return stage(
        rows.join(firsts, "pos", "left").select(
            "conv_id", "turn", "pos", "block", "initial", fault.otherwise(".").alias("fault")
        ),
        "turn-faults",
    )


_TABLE = "array<struct<start:int,top:int,cost:long,audit:string>>"
_TABLE_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("top", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
)


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[str, str, bool], list] = {}
    for batch in batches:
        tables = []
        for key in zip(*(batch.column(c).to_pylist() for c in ("initials", "faults", "first")), strict=True):
            if key not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                initials, faults, first = key
                known[key] = [
                    {"start": start, "top": top, "cost": cost, "audit": audit}
                    for start in ([START] if first else STACKS)
                    for top, (cost, audit) in parse(initials, faults, start).items()
                ]
            tables.append(known[key])
        kept = ["conv_id", "block", "initials"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(tables, _TABLE_TYPE)], names=[*kept, "tops"]
        )


def _table(entries: list[dict]) -> dict[int, Tops]:
    table: dict[int, Tops] = {}
    for e in entries:
        table.setdefault(e["start"], {})[e["top"]] = (e["cost"], e["audit"])
    return table


_PIECES = "array<struct<block:long,start:int,edits:string>>"
_PIECES_TYPE = pa.list_(
    pa.struct([("block", pa.int64()), ("start", pa.int32()), ("edits", pa.string())])
)


_REPAIRS = [
    ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("pieces", _PIECES_TYPE)
]


def _compose_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: list[tuple] = []
        size = begin = 0
        for at, row in enumerate(batch.column("blocks")):
            blocks = row.as_py()
            cost, audit = cheapest(compose_all([_table(b["tops"]) for b in blocks]))
            initials = [b["initials"] for b in blocks]
            pieces = [
                {"block": b["block"], "start": start, "edits": edits}
                for b, (start, edits) in zip(blocks, pieces_of(audit, initials), strict=True)
            ]
            held.append((cost, audit, illegal_pairs("".join(initials)), pieces))
            size += len(audit)
            if size > 1_000_000 or at == batch.num_rows - 1:
                columns = zip(zip(*held, strict=True), _REPAIRS, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("conv_id").slice(begin, len(held)),
                        *(pa.array(values, kind) for values, (_, kind) in columns),
                    ],
                    names=["conv_id", *(name for name, _ in _REPAIRS)],
                )
                held, size, begin = [], 0, at + 1


def repairs(faults: DataFrame) -> DataFrame:
    """Per conversation of ``faults``: cost, audit, illegal pairs, and the edits by block
    (pieces), as a stored table."""
    key = faults.schema["conv_id"].dataType.simpleString()
    rows = F.array_sort(F.collect_list(F.struct("pos", "initial", "fault")))
    inside = F.min(F.col("pos").bitwiseAND((1 << BLOCK_BITS) - 1)) > 0

    def letters(name: str) -> Column:
        return F.array_join(F.transform("rows", lambda r: r[name]), "")

    blocks = (
        faults.groupBy("conv_id", "block")
        # a conversation that begins inside of a block begins there with an empty stack
        .agg(rows.alias("rows"), inside.alias("first"))
        .select(
            "conv_id", "block", letters("initial").alias("initials"), letters("fault").alias("faults"), "first"
        )
        .mapInArrow(
            lean(_parse_blocks), f"conv_id {key}, block long, initials string, tops {_TABLE}"
        )
    )
    return stage(
        blocks.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("block", "initials", "tops"))).alias("blocks"))
        .mapInArrow(
            lean(_compose_conversations),
            f"conv_id {key}, cost long, audit string, illegal long, pieces {_PIECES}",
        ),
        "repairs",
    )


def _with_edits(turns: DataFrame, found: DataFrame) -> DataFrame:
    pieces = found.select(
        F.col("conv_id").alias("_conv"), F.explode("pieces").alias("_piece")
    ).select("_conv", F.col("_piece.block").alias("_block"), "_piece.start", "_piece.edits")
    same = turns["conv_id"].eqNullSafe(pieces["_conv"]) & (turns["block"] == pieces["_block"])
    return turns.join(pieces, same).select(
        "conv_id", "block", "pos", "role", "text", "initial", "start", "edits"
    )


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, pos, list of repaired (edit, role, text)) for rows in order; the rows of a
    block stand together."""
    block: tuple | None = None
    edits: list[str] = []
    at = top = 0
    rest = ""
    columns = ("conv_id", "block", "pos", "role", "text", "initial", "start", "edits")
    for part in slices(batches, "text"):
        rows = zip(*(part.column(c).to_pylist() for c in columns), strict=True)
        for conv, number, pos, role, text, initial, start, spelled in rows:
            if block != (conv, number):
                block, at, top = (conv, number), 0, start
                edits = EDIT.findall(spelled)
                rest = spelled[sum(map(len, edits)) :]
            out = []
            for letter in edits[at] + (rest if at == len(edits) - 1 else ""):
                if letter == "K":
                    out.append(("K", role, text))
                elif letter in "RI":
                    out.append((letter, NAMES[_wanted(top)], text if letter == "R" else ""))
                top = _after(top, letter, initial)
            at += 1
            yield conv, pos, out


def _rows(key: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [("conv_id", key), ("pos", pa.int64()), ("place", pa.int32()), ("edit", pa.string()),
         ("role", pa.string()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for conv, pos, out in _replayed(batches):
            for place, (edit, role, text) in enumerate(out):
                held.append((conv, pos, place, edit, role, text))
                size += len(text) + 100
            if size > 1_000_000:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema,
    )


def _hashes(key: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("conv_id", key), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, digest, lines = None, None, 0
        for conv, _, out in _replayed(batches):
            if digest is None or conv != current:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                current, digest, lines = conv, hashlib.sha256(), 0
            for _, role, text in out:
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
            if len(done) >= 10_000:
                yield _batch(done, schema)
                done = []
        if digest is not None:
            done.append((current, digest.hexdigest()))
        if done:
            yield _batch(done, schema)

    return run


def _arrow_key(turns: DataFrame) -> pa.DataType:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return kinds[dict(turns.dtypes)["conv_id"]]


def repaired_rows(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, pos and place (which order the rows of a
    conversation), the edit that made the row (K, R or I), role and text. Spread by block."""
    key = turns.schema["conv_id"].dataType.simpleString()
    rows = _with_edits(turns, found).repartition("conv_id", "block")
    return rows.sortWithinPartitions("conv_id", "block", "pos").mapInArrow(
        lean(_rows(_arrow_key(turns))),
        f"conv_id {key}, pos long, place int, edit string, role string, text string",
    )


def repaired_hashes(turns: DataFrame, found: DataFrame) -> DataFrame:
    """SHA-256 of the repaired rows of a conversation, ``role:text`` joined by newlines."""
    key = turns.schema["conv_id"].dataType.simpleString()
    rows = _with_edits(turns, found).repartition("conv_id")
    return rows.sortWithinPartitions("conv_id", "pos").mapInArrow(
        lean(_hashes(_arrow_key(turns))), f"conv_id {key}, repaired_sha256 string"
    )


def repair_report(conv_ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct conv_id of ``conv_ids``: gaps and faults of its rows in ``turns``
    (see ``in_order``), cost and audit of the repair, and the hash of the repaired rows."""
    faults = faults_of(turns)
    found = repairs(faults)

    def times(fault: str, name: str) -> Column:
        return F.count_if(F.col("fault") == fault).alias(name)

    counts = faults.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        times("b", "blank"),
        times("d", "duplicate"),
        times("t", "truncated"),
    )
    result = conv_ids.select("conv_id").distinct()
    for part in (counts, found.select("conv_id", "cost", "audit", "illegal"), repaired_hashes(turns, found)):
        part = part.withColumnRenamed("conv_id", "_conv")
        result = result.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)

    return result.select(
        "conv_id",
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The parse by a recursive table: states are the tops of the stack as structs of cost, audit and
# the repaired rows so far.
SQL = r"""
WITH RECURSIVE crc_bits AS (
  SELECT i AS byte, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
  FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY byte) AS t FROM crc_bits WHERE k = 8),
raw AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
kinds AS (
  SELECT raw.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS h
  FROM raw, crc_table),
damaged AS (
  SELECT c, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) t(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c
    ORDER BY turn NULLS FIRST, role, left(text, 32), sha256(text)) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS seen FROM damaged),
faulty AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS ini,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
         WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
         WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS f FROM ordered),
walk AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, struct_pack(c := 0, a := '', o := '') AS s0,
         CAST(NULL AS STRUCT(c INT, a VARCHAR, o VARCHAR)) AS s1,
         CAST(NULL AS STRUCT(c INT, a VARCHAR, o VARCHAR)) AS s2,
         CAST(NULL AS STRUCT(c INT, a VARCHAR, o VARCHAR)) AS s3 FROM faulty
  UNION ALL
  SELECT c, i + 1,
    struct_pack(c := s0.c + 2, a := s0.a || 'D', o := s0.o),
    least(CASE WHEN s1 IS NOT NULL THEN struct_pack(c := s1.c + 2, a := s1.a || 'D', o := s1.o) END,
          CASE WHEN ini = 's' AND f NOT IN ('b', 'd')
               THEN struct_pack(c := s0.c + paid, a := s0.a || 'K', o := s0.o || line) END),
    least(struct_pack(c := o2.c + 2, a := o2.a || 'D', o := o2.o),
          CASE WHEN ini = 'u' AND f NOT IN ('b', 'd')
               THEN struct_pack(c := asked.c + paid, a := asked.a || 'K', o := asked.o || line) END,
          CASE WHEN f NOT IN ('b', 'd')
               THEN struct_pack(c := asked.c + paid + 1, a := asked.a || 'R',
                                o := asked.o || chr(10) || 'user:' || text) END),
    least(struct_pack(c := o3.c + 2, a := o3.a || 'D', o := o3.o),
          CASE WHEN ini = 'a' AND f NOT IN ('b', 'd')
               THEN struct_pack(c := o2.c + paid, a := o2.a || 'K', o := o2.o || line) END,
          CASE WHEN f NOT IN ('b', 'd')
               THEN struct_pack(c := o2.c + paid + 1, a := o2.a || 'R',
                                o := o2.o || chr(10) || 'assistant:' || text) END)
  FROM (
    SELECT *, least(s3, struct_pack(c := o2.c + 5, a := o2.a || 'I', o := o2.o || chr(10) || 'assistant:')) AS o3,
           least(s0, s1, least(s3, struct_pack(c := o2.c + 5, a := o2.a || 'I',
                                               o := o2.o || chr(10) || 'assistant:'))) AS asked
    FROM (
      SELECT w.*, q.ini, q.f, q.text, CASE WHEN q.f = 't' THEN 5 ELSE 0 END AS paid,
             chr(10) || q.role || ':' || q.text AS line,
             least(s2, struct_pack(c := least(s0, s1, s3).c + 5, a := least(s0, s1, s3).a || 'I',
                                   o := least(s0, s1, s3).o || chr(10) || 'user:')) AS o2
      FROM walk w JOIN faulty q ON q.c = w.c AND q.i = w.i + 1))),
ends AS (
  SELECT c, least(s0, s3, CASE WHEN s2 IS NOT NULL THEN struct_pack(
           c := s2.c + 5, a := s2.a || 'I', o := s2.o || chr(10) || 'assistant:') END,
         CASE WHEN s1 IS NOT NULL THEN struct_pack(
           c := s1.c + 10, a := s1.a || 'II', o := s1.o || chr(10) || 'user:' || chr(10) || 'assistant:') END) AS best
  FROM walk QUALIFY row_number() OVER (PARTITION BY c ORDER BY i DESC) = 1),
counts AS (
  SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (f = 'b') AS blank,
         count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated FROM faulty GROUP BY c),
pairs AS (
  SELECT c, left(lag(role) OVER (PARTITION BY c ORDER BY i), 1) || left(role, 1) AS p FROM faulty),
illegal AS (SELECT c, count(*) FILTER (p NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM raw) LEFT JOIN counts USING (c) LEFT JOIN illegal USING (c)
LEFT JOIN ends USING (c)
"""
