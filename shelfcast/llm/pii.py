r"""Personal data: base rules, proposed candidates, boosted trees, redaction.

Base rules find e-mail addresses, IP addresses, card and phone numbers by format and check.
On top of them loose generators propose overlapping candidates, several from every start, also
beside base spans and other numbers; boosted trees score each by
its format and the characters around it; a calibrated probability per kind decides which are
added. It is a logistic curve over the scores of the candidates of all documents that the trees
did not learn from, one curve for all kinds with an offset for each that shrinks to nothing
where a kind is rare, so it is defined at any size. The trees learn from documents of a bounded
sample, where base spans are the positive candidates; checksums are no feature, so what looks
and stands like personal data scores high although a check fails.

Of overlapping candidates above the threshold the one with the highest score is added, then the
next that overlaps none. A run of more than ``PIECE`` candidates that overlap one after another is
cut into pieces of so many; where what is added in neighbouring pieces overlaps, the better stays.

All of it is expressions over one row: the trees become CASE expressions, so scoring is a
part of the scan, without shuffle or Python. Positions are sums in two levels, overlaps are
looked up by halving sorted spans and text is cut out of windows, so work grows with the length
of a text, not with its square.

Semantics: a null text is empty and has no spans. Positions are code points, ends exclusive.
Equal texts get equal spans. Where the sample has no positive or no negative candidates nothing
is added. Other columns are kept untouched.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import labelled_sample, uniform_key
from shelfcast.sources.staging import stage

# The kinds in their order and the base formats. Runs are possessive and begin
# where no run of the same characters is under way, so a scan is linear in the text; \G lets a
# match begin where the last one ended.
KINDS = ("email", "ip", "card", "phone")
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# every character is a digit, or a separator between two digits: no group to recurse into
CARD = r"(?<![0-9]|[0-9][ -])[0-9](?:[0-9 -](?<=[0-9]|[0-9][ -](?=[0-9])))++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

# Loose formats that propose candidates. Of e-mail addresses there is a wide one, and a narrow
# one that begins at every run of address characters: its head, then what follows it.
WIDE_EMAIL = (
    r"(?<![^\s<>()\[\]\"',;])[^\s@<>()\[\]\"',;]{1,64}+"
    r"(?:@|\s?[\[(]at[\])]\s?)[^\s@<>()\[\]\"',;]{2,255}+"
)
EMAIL_HEAD = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,64}+(?:@|\s?[\[(]at[\])]\s?)(?=[A-Za-z0-9])"
)
EMAIL_TAIL = r"^[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
# The other kinds are runs of digit groups: from every group on, every run of at most LONGEST
# characters in the format of a kind. Groups are looked at in blocks of 64; a run that begins in
# a block may end behind it.
BLOCK = r"(?<![0-9])[0-9](?=[0-9 ().:+-]{5})[0-9]*+(?:[ ().:+-]{1,28}[0-9]++){0,63}+"
LONGEST = 40
LOOSE = {
    "ip": r"^[0-9]{1,4}(?:[.:-][0-9]{1,4}){3}$",
    # 12 to 20 digits, also with a separator between every two
    "card": r"^(?=(?:[^0-9]?[0-9]){12,20}$)[0-9][0-9 .-]{10,38}[0-9]$",
    "phone": r"^[+(]{0,2}[0-9][0-9 ().-]{5,22}[0-9]$",
}
# Words around a candidate that speak for a kind.
CUES = (
    "mail|contact|write",
    "phone|tel|call|fax|mobil|reach",
    "card|visa|credit|pay|iban|account",
    r"\bip\b|host|server|addr|login|from",
    r"version|\bno\b|order|isbn|page|build|chapter",
)
CONTEXT = 32

# Documented parameters: documents to learn from, trees, their depth, precision of added spans.
SAMPLE_DOCS = 20_000
TREES, DEPTH, SEED = 12, 3, 42
# Probability from which a candidate is added; steps and range of the scores that are counted;
# how strongly the calibration keeps to that of the trees where there is little to see.
PRECISION, STEPS, RANGE, RIDGE = 0.9, 5, 8, 1.0
PIECE = 256
# Numbers added up at a time, spans that share a window.
LEVEL, GROUP = 256, 64

_SPANS = "array<struct<start:int,end:int,value:string>>"


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def chunks(array: Column, size: int) -> Column:
    """The array cut into arrays of ``size``; one empty array for an empty one."""
    last = F.greatest(F.floor((F.size(array) - 1) / size), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(array, i * size + 1, size))


def running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` makes of 0 and all numbers before each place. An array that grows by
    one number after the other is copied every time, so it is done in two levels."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        out = F.concat(acc["out"], F.array(acc["at"]))
        return F.struct(combine(acc["at"], x).alias("at"), out.alias("out"))

    def of(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), combine))
        begins = F.aggregate(totals, start, step, lambda acc: acc["out"])

        def inside(block: Column, begin: Column) -> Column:
            own = F.struct(begin.alias("at"), F.array().cast("array<int>").alias("out"))
            return F.aggregate(block, own, step, lambda acc: acc["out"])

        return F.flatten(F.zip_with(blocks, begins, inside))

    return let(chunks(numbers, LEVEL), of)


def spans_of(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` with their positions: gaps and matches alternate."""

    def placed(values: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(values))
        sizes = F.zip_with(
            gaps, values, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("n"), v.alias("v"))
        )

        def ends(found: Column) -> Column:
            lengths = F.transform(found, lambda x: x["gap"] + x["n"])
            return F.zip_with(
                found,
                running(lengths, lambda a, b: a + b),
                lambda x, at: F.struct(
                    (at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("end"), x["v"].alias("value")
                ),
            )

        return let(sizes, ends)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _none() -> Column:
    return F.array().cast(_SPANS)


_INDEX = "array<struct<start:int,end:int,kind:int,reach:int>>"


def span_index(spans: Column) -> Column:
    """Spans (kind, start, end) by start, each with the largest end so far."""

    def with_reach(found: Column) -> Column:
        before = running(F.transform(found, lambda s: s["end"]), _larger)
        return F.zip_with(
            found,
            before,
            lambda s, at: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                F.greatest(at, s["end"]).alias("reach"),
            ),
        )

    by_start = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return F.when(F.size(spans) > 0, let(by_start, with_reach)).otherwise(F.array().cast(_INDEX))


def _first(array: Column, holds: Callable[[Column], Column]) -> Column:
    """Index of the first element for which ``holds``, which then holds for all behind it; by
    halving."""
    turns = F.sequence(F.lit(0), F.ceil(F.log2(F.size(array) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(array).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        before = holds(F.get(array, mid))
        return (
            F.when(acc["low"] >= acc["high"], acc)
            .when(before, F.struct(acc["low"].alias("low"), mid.alias("high")))
            .otherwise(F.struct((mid + 1).alias("low"), acc["high"].alias("high")))
        )

    return F.aggregate(turns, start, halve, lambda acc: acc["low"])


def spans_near(index: Column, begin: Column, end: Column) -> Column:
    """The spans of an index that can overlap the positions from ``begin`` to ``end``."""
    low = _first(index, lambda s: s["reach"] > begin)
    high = _first(index, lambda s: s["start"] >= end)
    near = F.slice(index, low + 1, F.greatest(high - low, F.lit(0)))
    return F.when(F.size(index) > 0, near).otherwise(index)


def _few_spans_of(text: Column, pattern: str) -> Column:
    """``spans_of`` for a text with some dozen matches: in one level."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(values)),
        values,
        lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("n")),
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")
    )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["n"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the check: from the right every second one counts double."""
    digits = F.split(F.reverse(_digits(value)), "")
    worth = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, d: a + d) % 10 == 0


def _check(valid: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda s: valid(s["value"])


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda s: F.named_struct(
        F.lit("kind"), F.lit(number), F.lit("start"), s["start"], F.lit("end"), s["end"]
    )


def base_spans(text: Column) -> Column:
    """Spans (kind as a number, start, end) of the base rules, by kind and start."""
    n_digits: Callable[[Column], Column] = lambda v: F.length(_digits(v))
    # what a text must hold for a rule to be tried at all, its format, its check
    rules = (
        (F.contains(text, F.lit("@")), EMAIL, lambda v: F.lit(True)),
        (
            text.rlike(r"[0-9]\.[0-9]"),
            IP,
            lambda v: v.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"),
        ),
        (
            text.rlike("[0-9](?:[ -]?[0-9]){12}"),
            CARD,
            lambda v: n_digits(v).between(13, 19) & F.when(
                n_digits(v).between(13, 19), _luhn(v)
            ).otherwise(False),
        ),
        (F.contains(text, F.lit("+")), PHONE, lambda v: n_digits(v).between(9, 15)),
    )
    found = []
    for number, (possible, pattern, valid) in enumerate(rules):
        spans = F.when(possible, spans_of(text, pattern)).otherwise(_none())
        found.append(F.transform(F.filter(spans, _check(valid)), _of_kind(number)))
    return F.concat(*found)


def _candidate(number: int, w: Column, start: Column, end: Column) -> Column:
    """A candidate with its surroundings and how it lies to base spans: ``same`` as one of its
    kind, on one of its own kind, or on any (``taken``). The window ``w`` holds the text from
    position ``at`` of the document on and the base spans near it."""
    text, at = w["window"], w["at"]
    mine = F.filter(w["near"], lambda b: (b["start"] < end) & (start < b["end"]))
    own = F.filter(mine, lambda b: b["kind"] == number)
    parts = {
        "kind": F.lit(number),
        "start": start,
        "end": end,
        "value": F.substring(text, start - at + 1, end - start),
        "before": F.substring(
            text,
            F.greatest(start - at - CONTEXT, F.lit(0)) + 1,
            F.least(start - at, F.lit(CONTEXT)),
        ),
        "after": F.substring(text, end - at + 1, F.lit(CONTEXT // 2)),
        "taken": F.size(mine) > 0,
        "own": F.size(own) > 0,
        "same": F.exists(own, lambda b: (b["start"] == start) & (b["end"] == end)),
    }
    return F.named_struct(*[x for k, v in parts.items() for x in (F.lit(k), v)])


def _window(text: Column, index: Column, begin: Column, end: Column) -> dict[str, Column]:
    """The text and the base spans around the positions from ``begin`` to ``end``."""
    at = F.greatest(begin - CONTEXT, F.lit(0))
    return {
        "at": at,
        "window": F.substring(text, at + 1, end - at + CONTEXT // 2 + 2),
        "near": spans_near(index, begin, end),
    }


def _addresses(text: Column, index: Column) -> Column:
    """Candidates for e-mail addresses: wide ones and narrow ones, which may overlap."""
    tail = 255

    def group(spans: Column) -> Column:
        begin = spans[0]["start"]
        furthest = F.array_max(F.transform(spans, lambda s: s["end"])) + tail

        def inside(w: Column) -> Column:
            def whole(s: Column) -> Column:
                rest = F.substring(w["window"], s["end"] - w["at"] + 1, F.lit(tail))
                found = F.when(s["head"], F.regexp_extract(rest, EMAIL_TAIL, 0)).otherwise("")
                return F.struct(s["start"].alias("start"), (s["end"] + F.length(found)).alias("end"))

            ends = F.array_distinct(F.transform(spans, whole))
            return F.transform(ends, lambda s: _candidate(0, w, s["start"], s["end"]))

        around = _window(text, index, begin, furthest)
        return let(F.struct(*[value.alias(name) for name, value in around.items()]), inside)

    def marked(pattern: str, head: bool) -> Column:
        return F.transform(
            spans_of(text, pattern),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(head).alias("head")),
        )

    spans = F.array_sort(F.concat(marked(WIDE_EMAIL, False), marked(EMAIL_HEAD, True)))
    groups = let(spans, lambda found: F.filter(chunks(found, GROUP), lambda g: F.size(g) > 0))
    return F.flatten(F.transform(groups, group))


def _runs_in(text: Column, index: Column) -> Callable[[Column], Column]:
    """Candidates for the other kinds that begin in a block of digit groups."""

    def runs(block: Column) -> Column:
        length = block["end"] - block["start"]
        body = F.substring(text, block["start"] + 1, length + LONGEST + 1)
        parts = {
            **_window(text, index, block["start"] - 2, block["end"] + LONGEST),
            "groups": _few_spans_of(body, "[0-9]++"),
        }
        around = F.struct(*[value.alias(name) for name, value in parts.items()])
        return let(around, lambda w: _runs_of(w, block["start"], length))

    return runs


def _runs_of(w: Column, block_start: Column, length: Column) -> Column:
    window, at, groups = w["window"], w["at"], w["groups"]

    def from_group(first: Column, place: Column) -> Column:
        start = block_start + first["start"]
        lead = F.substring(
            window, F.greatest(start - at - 3, F.lit(0)) + 1, F.least(start - at, F.lit(3))
        )
        sign = F.length(F.regexp_extract(lead, r"(?<![0-9A-Za-z])[+(]{1,2}$", 0))
        apart = ~lead.rlike("[0-9A-Za-z]$")
        # groups and the separators between them take two characters each at least
        ends = F.filter(
            F.slice(groups, place + 1, LONGEST // 2 + 1),
            lambda g: (g["end"] > first["start"] + 5) & (g["end"] <= first["start"] + LONGEST),
        )

        def kinds(last: Column) -> Column:
            end = block_start + last["end"]
            value = F.substring(window, start - at + 1, end - start)
            proposed = []
            for number, kind in enumerate(KINDS):
                if kind in LOOSE:
                    # the format is looked at before anything else of a candidate is made
                    fits = value.rlike(LOOSE[kind])
                    if kind == "phone":
                        signed = F.substring(window, start - sign - at + 1, end - start + sign)
                        fits = signed.rlike(LOOSE[kind])
                    if kind != "card":
                        fits = fits & apart
                    begin = start - sign if kind == "phone" else start
                    proposed.append(F.when(fits, _candidate(number, w, begin, end)))
            return F.array_compact(F.array(*proposed))

        return F.flatten(F.transform(ends, kinds))

    starts = F.filter(groups, lambda g: g["start"] < length)
    return F.flatten(F.transform(starts, from_group))


def candidates(text: Column, index: Column | None = None) -> Column:
    """What the loose generators propose: kind, start, end, value and its surroundings, and how
    each lies to the base spans of ``index`` (none by default). Spans overlap, also within a
    kind."""
    if index is None:
        index = F.array().cast(_INDEX)
    at = F.contains(text, F.lit("@")) | F.contains(text, F.lit("at]"))
    at = at | F.contains(text, F.lit("at)"))
    w = F.struct(F.lit(0).alias("at"), text.alias("window"), index.alias("near"))
    none = F.filter(F.array(_candidate(0, w, F.lit(0), F.lit(0))), lambda c: F.lit(False))
    blocks = F.when(text.rlike("[0-9][0-9 ().:+-]{5}"), spans_of(text, BLOCK)).otherwise(_none())
    return F.concat(
        F.when(at, _addresses(text, index)).otherwise(none),
        F.flatten(F.transform(blocks, _runs_in(text, index))),
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def features(c: Column) -> Column:
    """Format and context of a candidate as numbers; checks of the base rules are none."""
    value, before, after = c["value"], F.lower(c["before"]), F.lower(c["after"])
    n_digits = F.length(_digits(value)).cast("double")
    groups = F.regexp_count(value, F.lit("[0-9]+")).cast("double")

    def count(what: str) -> Column:
        return F.regexp_count(value, F.lit(what)).cast("double")

    return F.array(
        *[_flag(c["kind"] == k) for k in range(len(KINDS))],
        F.length(value).cast("double"),
        n_digits,
        groups,
        n_digits / F.greatest(groups, F.lit(1.0)),
        count("[A-Za-z]"),
        count(r"\."),
        count("-"),
        count(" "),
        count("[()]"),
        count("@"),
        _flag(value.startswith("+")),
        F.coalesce(F.substring(_digits(value), 1, 1).try_cast("double"), F.lit(-1.0)),
        _flag(value.rlike(r"\.[A-Za-z]{2,}$")),
        _flag(value.rlike("[0-9]{13,}")),
        _flag(value.rlike("[2-9][0-9]{3}(?![0-9])")),
        _flag(before.rlike(r"[\p{L}\p{N}]$")),
        _flag(before.rlike(r"[\s]$")),
        _flag(after.rlike(r"^[\p{L}\p{N}]")),
        _flag(after.rlike(r"^[.,;:!?]?(\s|$)")),
        *[_flag(before.rlike(cue) | after.rlike(cue)) for cue in CUES],
    )


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _best_apart(chosen: Column) -> Column:
    """Of candidates (start, end, order, kind) by start those that stay: the best of a run that
    overlaps, then the best that overlaps none taken. ``order`` is unique among them."""
    empty = F.array().cast("array<struct<order:int,start:int,end:int,kind:int>>")

    def take(piece: Column) -> Column:
        def step(taken: Column, c: Column) -> Column:
            return F.when(F.exists(taken, lambda t: _overlap(t, c)), taken).otherwise(
                F.concat(taken, F.array(c))
            )

        by_order = F.transform(
            piece,
            lambda c: F.struct(
                c["order"].alias("order"), c["start"].alias("start"), c["end"].alias("end"),
                c["kind"].alias("kind"),
            ),
        )
        return F.aggregate(F.array_sort(by_order), empty, step)

    def pieces(found: Column) -> Column:
        reach = running(F.transform(found, lambda c: c["end"]), _larger)
        places = F.sequence(F.lit(0), F.size(found) - 1)

        def cut(begins: Column) -> Column:
            def own(begin: Column, i: Column) -> Column:
                end = F.coalesce(F.get(begins, i + 1), F.size(found))
                parts = F.sequence(begin, end - 1, F.lit(PIECE))
                return F.transform(
                    parts, lambda at: take(F.slice(found, at + 1, F.least(end - at, F.lit(PIECE))))
                )

            return F.flatten(F.transform(begins, own))

        return let(
            reach,
            lambda r: let(F.filter(places, lambda i: F.get(found, i)["start"] >= F.get(r, i)), cut),
        )

    def borders(taken: Column) -> Column:
        def stays(piece: Column, i: Column) -> Column:
            beside = F.concat(
                F.coalesce(F.get(taken, i - 1), empty), F.coalesce(F.get(taken, i + 1), empty)
            )
            return F.filter(
                piece,
                lambda c: ~F.exists(beside, lambda b: _overlap(b, c) & (b["order"] < c["order"])),
            )

        return F.flatten(F.transform(taken, stays))

    resolved = let(let(chosen, pieces), borders)
    return F.when(F.size(chosen) > 0, resolved).otherwise(empty)


_RANKED = "array<struct<start:int,end:int,order:int,kind:int>>"


@dataclass(frozen=True)
class Redactor:
    """Boosted trees as nested tuples (feature, threshold, left, right) or leaf values, their
    weights, and the log odds from which a candidate of a kind is redacted (None: never)."""

    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    thresholds: tuple = (None,) * len(KINDS)

    def log_odds(self, f: Column) -> Column:
        """Log odds for a column of features, before calibration."""

        def grow(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, threshold, left, right = node
            return F.when(F.get(f, F.lit(feature)) <= threshold, grow(left)).otherwise(grow(right))

        margin = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            margin = margin + grow(tree) * weight
        return 2 * margin

    def chosen(self, text: Column, index: Column) -> Column:
        """Candidates from the threshold of their kind on that overlap no base span, by start;
        ``order`` is the rank by score, then length, then place."""
        if all(t is None for t in self.thresholds):
            return F.array().cast(_RANKED)
        limits = F.array(*[F.lit(math.inf if t is None else float(t)) for t in self.thresholds])
        free = F.filter(candidates(text, index), lambda c: ~c["taken"])
        scored = F.transform(
            F.transform(
                free,
                lambda c: F.struct(
                    c["kind"].alias("kind"),
                    c["start"].alias("start"),
                    c["end"].alias("end"),
                    features(c).alias("f"),
                ),
            ),
            lambda c: F.struct(
                # how far beyond the threshold: the same measure for all kinds
                (F.get(limits, c["kind"]) - self.log_odds(c["f"])).alias("order"),
                (c["start"] - c["end"]).alias("shortness"),
                c["start"].alias("start"),
                c["end"].alias("end"),
                c["kind"].alias("kind"),
            ),
        )
        best_first = F.array_sort(F.filter(scored, lambda c: c["order"] <= 0))
        ranked = F.transform(
            best_first,
            lambda c, i: F.struct(
                c["start"].alias("start"), c["end"].alias("end"), i.alias("order"), c["kind"].alias("kind")
            ),
        )
        return F.array_sort(ranked)


def _node(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (
        int(split.featureIndex()),
        float(split.threshold()),
        _node(node.leftChild()),
        _node(node.rightChild()),
    )


def _trees(model: GBTClassificationModel) -> list:
    return [_node(tree._call_java("rootNode")) for tree in model.trees]


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """Candidates of ``docs`` (doc_id, text): doc_id, kind, features and whether they are a base
    span of their kind. Those that only overlap one are left out, as they are never added and
    no example of what is none."""
    text = F.coalesce("text", F.lit("")).alias("text")
    # step by step: the analysis of lambdas in lambdas takes a pass each
    indexed = docs.select("doc_id", text, base_spans(text).alias("base")).select(
        "doc_id", "text", span_index(F.col("base")).alias("index")
    )
    examples = F.filter(
        candidates(F.col("text"), F.col("index")), lambda c: ~c["own"] | c["same"]
    )
    rows = indexed.select("doc_id", F.explode(examples).alias("c"))
    c = F.col("c")
    return rows.select(
        "doc_id",
        c["kind"].alias("kind"),
        features(c).alias("features"),
        c["same"].cast("double").alias("label"),
    )


def _learned_from() -> Column:
    """Of the sampled documents three in four are learned from."""
    return F.col("doc_id").isNotNull() & (uniform_key("doc_id", seed=11) % 4 > 0)


def training_candidates(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Candidates of the documents to learn from, with the key the sample is ordered by."""
    every = docs.select("doc_id", F.lit(1).alias("label"))
    sample = labelled_sample(docs, every, sample_docs).where(_learned_from())
    return labelled_candidates(sample.select("doc_id", "text")).withColumn(
        "key", uniform_key("doc_id", seed=7)
    )


def score_counts(docs: DataFrame, model: Redactor, last_key: int) -> list:
    """Candidates (n) and those that are base spans (hits) per kind and step of the log odds,
    over all documents but those learned from: at most 2 * STEPS * RANGE + 1 rows per kind. A
    document was sampled where its key is not above ``last_key``."""
    learned = (uniform_key("doc_id", seed=7) <= last_key) & _learned_from()
    # the lambda computes the features of a candidate once for all nodes of the trees
    odds = F.transform(F.array("features"), model.log_odds)[0]
    step = F.round(F.greatest(F.least(odds, F.lit(RANGE)), F.lit(-RANGE)) * STEPS).cast("int")
    return (
        labelled_candidates(docs.where(~F.coalesce(learned, F.lit(False))))
        .select("kind", "label", step.alias("step"))
        .groupBy("kind", "step")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
        .collect()
    )


def calibrate(counts: list) -> np.ndarray:
    """Intercept and slope of a logistic curve over the log odds of the trees, and an offset per
    kind, from rows (kind, step, n, hits). Ridges pull them to 0, 1 and 0: without rows the
    probability is that of the trees, a rare kind follows the common curve."""
    design = np.zeros((len(counts), 2 + len(KINDS)))
    for row, r in enumerate(counts):
        design[row, :2] = 1.0, r["step"] / STEPS
        design[row, 2 + r["kind"]] = 1.0
    n = np.array([float(r["n"]) for r in counts])
    hits = np.array([float(r["hits"]) for r in counts])
    prior = np.array([0.0, 1.0] + [0.0] * len(KINDS))
    w = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * p - hits) + RIDGE * (w - prior)
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(len(w))
        change = np.linalg.solve(hessian, gradient)
        w -= np.clip(change, -1, 1)
        if np.abs(change).max() < 1e-9:
            break
    return w


def fit_redactor(
    docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION
) -> Redactor:
    """Learn the trees on three in four documents of the sample and the calibration on the
    candidates of all other documents. A kind is redacted from the log odds on at which the
    calibrated probability is ``precision``."""
    rows = stage(training_candidates(docs, sample_docs), "pii-candidates")
    seen = rows.agg(F.collect_set("label").alias("labels"), F.max("key").alias("key")).first()
    if set(seen["labels"]) != {0.0, 1.0}:
        return Redactor()
    trainer = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxMemoryInMB=64
    )
    train = rows.select(array_to_vector("features").alias("features"), "label")
    fitted = trainer.fit(train)
    model = Redactor(_trees(fitted), list(fitted.treeWeights))
    intercept, slope, *offsets = calibrate(score_counts(docs, model, seen["key"]))
    wanted = math.log(precision / (1 - precision))
    thresholds = tuple(
        float((wanted - intercept - offset) / slope) if slope > 0 else None for offset in offsets
    )
    return Redactor(model.trees, model.weights, thresholds)


def find_spans(
    docs: DataFrame,
    redactor: Redactor,
    *,
    text: str = "text",
    base: str = "pii_base",
    every: str = "pii_spans",
) -> DataFrame:
    """``docs`` with the columns ``base`` and ``every`` (all spans), each an array of kind
    number, start and end, ordered by kind and start."""
    body = F.coalesce(F.col(text), F.lit(""))
    index, chosen = "__pii_index", "__pii_chosen"
    found = (
        docs.withColumn(base, base_spans(body))
        .withColumn(index, span_index(F.col(base)))
        .withColumn(chosen, redactor.chosen(body, F.col(index)))
        .withColumn(chosen, _best_apart(F.col(chosen)))
    )
    added = F.transform(
        chosen,
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    return found.withColumn(every, F.array_sort(F.concat(base, added))).drop(index, chosen)


def span_list(spans: Column | str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def _by_start(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))


def redact(text: Column, spans: Column) -> Column:
    """The text with a mark such as <PHONE> in place of each span; of overlapping spans the
    first is marked, and what the others reach beyond it goes too. A null text stays null.
    Pieces are cut out of windows over some spans each, not out of the whole text."""
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: _by_start(s)))

    def with_gaps(found: Column) -> Column:
        before = running(F.transform(found, lambda s: s["end"]), _larger)
        return F.zip_with(
            found,
            before,
            lambda s, at: F.struct(
                at.alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )

    def group(own: Column) -> Column:
        begin, end = own[0]["at"], F.array_max(F.transform(own, lambda s: s["start"]))

        def inside(window: Column) -> Column:
            def piece(s: Column) -> Column:
                gap = F.substring(
                    window, s["at"] - begin + 1, F.greatest(s["start"] - s["at"], F.lit(0))
                )
                mark = F.when(s["start"] >= s["at"], F.get(marks, s["kind"])).otherwise("")
                return F.concat(gap, mark)

            return F.array_join(F.transform(own, piece), "")

        return let(F.substring(text, begin + 1, F.greatest(end - begin, F.lit(0))), inside)

    def whole(found: Column) -> Column:
        end = F.array_max(F.transform(found, lambda s: s["end"]))
        rest = F.substring(text, end + 1, F.length(text))
        return F.concat(F.array_join(F.transform(chunks(found, GROUP), group), ""), rest)

    marked = let(let(by_start, with_gaps), whole)
    return F.when(F.size(spans) > 0, marked).otherwise(text)
