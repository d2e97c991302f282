r"""Filter interaction audit by the Hart-Mas-Colell potential.

Filters are the players of a game per part of the corpus: a coalition is worth the documents
that its filters remove together. The potential of a coalition is its worth and the potentials
of the coalitions with one filter less, summed and divided by its size; what a filter adds to
the potential of all of them is its Shapley value. Times the number of orders all of this is
whole numbers. Steps of an order are differences of coalitions: what is kept after a step is
what the coalition of the filters so far keeps.

Documents are reduced to the set of filters they fail before anything is shuffled by part; a
part then is at most 32 counts, whatever its share of the corpus. Copies are found by the
SHA-256 of the text: the smallest id of a text is a sum over all rows with a map-side half, and
rows are matched with it by text and id together, so a text that fills a third of the table
meets in no one task.

Semantics: a null text is an empty one. The words of a text are its runs of
``[^\x20\x09-\x0D]``. A null id is larger than none and so never a copy; rows that repeat the
smallest id of a text are no copies. Of labels that repeat an id any one counts. A null part is
the empty string. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD
from shelfcast.sources.staging import stage

# The filters and their bounds.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_sizes(text: Column) -> Column:
    """Words, distinct words, code points and capitals of a text, as a struct."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    length = F.length(text).cast("long")
    # an array of one binds the words, which are then found once
    return F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("words"),
            F.size(F.array_distinct(w)).cast("long").alias("distinct"),
            length.alias("length"),
            (length - F.length(F.translate(text, CAPITALS, ""))).alias("capitals"),
        ),
    )[0]


def text_failures(text: Column, sizes: Column) -> list[Column]:
    """Filters A to D: few words, few distinct words, many capitals, any symbol."""
    return [
        sizes["words"] < LEAST_WORDS,
        100 * sizes["distinct"] < LEAST_DISTINCT * sizes["words"],
        100 * sizes["capitals"] > MOST_CAPITALS * sizes["length"],
        text.rlike(SYMBOLS),
    ]


def _bits(failures: list[Column]) -> Column:
    mask = F.lit(0)
    for i, failed in enumerate(failures):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    return mask


def failed_filters(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """Rows (part, mask, good, toxic, n): documents of a part by the set of filters they fail,
    as bits in the order of FILTERS, and by their labels."""
    text = F.coalesce("text", F.lit(""))
    rows = (
        docs.select(
            "doc_id", F.coalesce(part, F.lit("")).alias("part"), text.alias("text"), text_sizes(text).alias("sizes")
        )
        .select(
            "doc_id",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            _bits(text_failures(F.col("text"), F.col("sizes"))).alias("mask"),
        )
        .groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    marks = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = stage(rows.join(marks, "doc_id", "left"), "audit-rows")
    firsts = (
        known.where("doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    flag = {c: F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")}
    return (
        known.join(firsts, ["digest", "doc_id"], "left")
        .withColumn("mask", F.col("mask") + F.when(copy, 1 << (len(FILTERS) - 1)).otherwise(0))
        .groupBy("part", "mask", flag["good"], flag["toxic"])
        .agg(F.sum("n").alias("n"))
    )


def coalitions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part an array over all coalitions, numbered by their bits: documents that none of
    the filters of the coalition removes (kept), and those with a label among them."""
    every = F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    sums = (
        counts.withColumn("coalition", F.explode(every))
        .where(F.col("mask").bitwiseAND(F.col("coalition")) == 0)
        .groupBy("part", "coalition")
        .agg(
            F.sum("n").alias("kept"),
            total(F.col("good"), "good"),
            total(F.col("toxic"), "toxic"),
        )
    )
    # parts of which the coalition of no filter keeps nothing do not exist, so none is lost
    entry = F.struct("coalition", F.struct("kept", "good", "toxic"))
    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("kept"), zero.alias("good"), zero.alias("toxic"))
    return (
        sums.groupBy("part")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
        .select(
            "part",
            F.transform(every, lambda s: F.coalesce(F.try_element_at("found", s), none)).alias("v"),
        )
    )


def potentials(values: Column, filters: str = FILTERS) -> Column:
    """Potentials of all coalitions, times the number of orders, as an array of longs; ``values``
    holds what each coalition keeps. Sub-coalitions have smaller numbers, so one pass does."""
    orders = factorial(len(filters))
    removed = lambda s: F.get(values, F.lit(0))["kept"] - F.get(values, s)["kept"]

    def step(done: Column, s: Column) -> Column:
        total = orders * removed(s)
        for i in range(len(filters)):
            bit = F.lit(1 << i)
            smaller = F.get(done, s - bit)
            total = total + F.when(s.bitwiseAND(bit) != 0, smaller).otherwise(0)
        # the quotient is whole: the size of a coalition divides the number of orders
        share = F.floor(F.try_divide(total, F.bit_count(s).cast("decimal(2,0)"))).cast("long")
        return F.concat(done, F.array(share))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit((1 << len(filters)) - 1)), F.array(F.lit(0).cast("long")), step
    )


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step; ``shapley`` is the Shapley value of the
    filter of the step times the number of orders."""
    full = (1 << len(filters)) - 1
    per_part = coalitions(counts, filters).withColumn("p", potentials(F.col("v"), filters))
    orders = F.split(F.lit(",".join(map("".join, permutations(filters)))), ",")
    steps = per_part.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(filters))))
    )
    bits = F.transform(
        F.split("filter_order", ""),
        lambda letter: F.pow(F.lit(2), F.instr(F.lit(filters), letter) - 1).cast("int"),
    )

    def after(n: Column) -> Column:
        return F.aggregate(F.slice("bits", 1, n), F.lit(0), lambda a, b: a + b)

    def kept(s: Column | str, what: str = "kept") -> Column:
        return F.get("v", s)[what]

    bit = F.get("bits", F.col("step") - 1)
    removed = kept("before") - kept("after")
    fails = kept(F.lit(0)) - kept("bit")
    return (
        steps.withColumn("bits", bits)
        .withColumns({"before": after(F.col("step") - 1), "after": after(F.col("step")), "bit": bit})
        .select(
            "part",
            "filter_order",
            "step",
            kept("after").alias("kept"),
            removed.alias("removed"),
            (fails - removed).alias("redundant"),
            (kept(F.lit(full) - F.col("bit")) - kept(F.lit(full))).alias("unique_fails"),
            (kept("before", "good") - kept("after", "good")).alias("good_lost"),
            (kept("before", "toxic") - kept("after", "toxic")).alias("toxic_lost"),
            (F.get("p", F.lit(full)) - F.get("p", F.lit(full) - F.col("bit"))).alias("shapley"),
        )
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of the five filters over ``docs`` (doc_id, text and ``part``) with ``labels``
    (doc_id, quality, toxic)."""
    return audit(failed_filters(docs, labels, F.col(part).cast("string")))


# Every order is played step by step here, and the Shapley value is the sum over all of them.
SQL = r"""
WITH flags AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m FROM flags),
marks AS (
  SELECT doc_id, max(coalesce(quality = 1, FALSE)) AS good, max(coalesce(toxic = 1, FALSE)) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
steps AS (
  SELECT o, CAST(s AS INT) AS step, bits[s] AS bit,
         CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INT) AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) t(s)),
played AS (
  SELECT part, o AS filter_order, step, bit,
    coalesce(sum(n) FILTER (m & (before + bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (m & before = 0 AND m & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (m & before <> 0 AND m & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (m = bit), 0) AS unique_fails,
    coalesce(sum(g) FILTER (m & before = 0 AND m & bit <> 0), 0) AS good_lost,
    coalesce(sum(x) FILTER (m & before = 0 AND m & bit <> 0), 0) AS toxic_lost
  FROM masks, steps GROUP BY part, o, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM played
"""
