"""Mixing sources to target weights.

Every row gets a hash-random key. The keys are cut into ranges per source (a range sort),
word counts are summed per range, then within the range, and the running sum is cut at the
exact budget of the source. A budget above the size of the source takes whole epochs first.

Semantics: a null text has size 0; a null source is a source of its own, ordered last; rows
of size 0 take nothing; without any words all targets are 0. Repeated rows are separate rows
with the same key: which of them is cut first makes no difference to the result as a whole.
Other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD, n_words, uniform_key
from shelfcast.sources.staging import stage

# Weights of the sources in order, repeating; most passes over a source.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
# Rows per key range: what one task sorts. A hot source gets more ranges, not longer ones.
RANGE_ROWS = 5_000
KEY_SPACE = float(1 << 60)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source of ``sizes`` (source, size): rows, source_size and target.

    Targets share the total by weight; one that reaches ``max_epochs`` times its source stops
    there and the others share the rest. That is a water level: with sources ordered by cap
    per weight, the level is the largest of those left after capping a prefix of them.
    """
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size")
    )
    by_name = Window.orderBy(F.asc_nulls_last("source"))  # one row per source from here on
    steps = F.array(*[F.lit(w) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sources.withColumn("weight", F.get(steps, place)).withColumn(
        "cap", F.col("source_size") * max_epochs
    )
    everything = Window.partitionBy()
    filled = Window.orderBy(
        F.col("cap") / F.col("weight"), F.asc_nulls_last("source")
    ).rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(filled), F.lit(0))

    level = (F.sum("source_size").over(everything) - before("cap")) / (
        F.sum("weight").over(everything) - before("weight")
    )
    return (
        weighted.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("_level") * F.col("weight"))
        )
        .select("source", "source_rows", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 42,
    range_rows: int = RANGE_ROWS,
    digest: bool = False,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, epochs (whole passes
    over the source) and taken (words the mix takes of it). With ``digest`` also text_crc32,
    so that rows with the same id can be told apart when the texts are joined back."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        n_words(text).alias("size"),
        *([F.crc32(text).alias("text_crc32")] if digest else []),
    )
    # the texts are read once; all that follows reads this narrow table
    sized = stage(sized, "mix-sizes").withColumn("_key", uniform_key("doc_id", seed=seed))
    targets = source_targets(sized, weights, max_epochs).withColumnRenamed("source", "_source")
    ranges = F.ceil(F.col("source_rows") / range_rows)
    rows = (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_range", F.floor(F.col("_key") / F.lit(KEY_SPACE) * ranges))
    )

    sums = rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_range")
    offsets = sums.select(
        F.col("source").alias("_source"),
        F.col("_range").alias("_of"),
        F.coalesce(
            F.sum("_sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )

    # ties: equal ids take the order of their sizes and texts, equal rows any
    ties = [c for c in ("doc_id", "size", "text_crc32") if c in rows.columns]
    within = Window.partitionBy("source", "_range").orderBy("_key", *ties)
    inside = F.coalesce(
        F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    budget = F.floor(F.col("target") + 0.5)
    placed = (
        # by range too: the join before leaves the rows of a source in one task
        rows.repartition("source", "_range")
        .withColumn("_inside", inside)
        .join(
            offsets,
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_of")),
        )
        .withColumn("_budget", budget)
        .withColumn(
            "epochs",
            F.coalesce(F.expr("_budget div nullif(source_size, 0)"), F.lit(0)).cast("int"),
        )
    )
    left = F.col("_budget") - F.col("epochs") * F.col("source_size")
    part = F.least(
        F.greatest(left - F.col("_offset") - F.col("_inside"), F.lit(0)), F.col("size")
    )
    return placed.withColumn("taken", F.col("epochs") * F.col("size") + part).select(
        *sized.drop("_key").columns, "source_size", "target", "epochs", "taken"
    )


def take_mix(docs: DataFrame, mix: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``mix`` takes (made of the same rows with ``digest``): one per
    whole pass, and one cut to its first words where the budget ends. A cut text is joined
    by single spaces; a row of which nothing is taken goes. Columns are those of ``docs``; names
    beginning with __mix are the function's own."""
    columns = docs.columns
    id_, crc = F.col(doc_id).alias("__mix_id"), F.crc32(text).alias("__mix_crc")
    # repeated rows are numbered on both sides, so that each takes its own share
    rows = docs.select("*", id_, crc)
    nth = Window.partitionBy("__mix_id", "__mix_crc").orderBy(F.lit(1))
    rows = rows.withColumn("__mix_nth", F.row_number().over(nth))
    shares = mix.where("taken > 0").select(
        F.col("doc_id").alias("__mix_mid"),
        F.col("text_crc32").alias("__mix_mcrc"),
        F.col("epochs").alias("__mix_epochs"),
        (F.col("taken") - F.col("epochs") * F.col("size")).alias("__mix_part"),
    )
    numbered = Window.partitionBy("__mix_mid", "__mix_mcrc").orderBy(F.desc("__mix_epochs"), F.desc("__mix_part"))
    shares = shares.withColumn("__mix_mnth", F.row_number().over(numbered))
    joined = rows.join(
        shares,
        F.col("__mix_id").eqNullSafe(F.col("__mix_mid"))
        & F.col("__mix_crc").eqNullSafe(F.col("__mix_mcrc"))
        & (F.col("__mix_nth") == F.col("__mix_mnth")),
    )
    last = F.col("__mix_epochs") + (F.col("__mix_part") > 0).cast("int")
    copies = joined.withColumn("__mix_pass", F.explode(F.sequence(F.lit(1), last)))
    first_words = F.array_join(
        F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("__mix_part").cast("int")),
        " ",
    )
    cut = F.when(F.col("__mix_pass") > F.col("__mix_epochs"), first_words).otherwise(F.col(text))
    return copies.withColumn(text, cut).select(*columns)


SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), 1, 15) AS BIGINT)
           AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT source, source_size, 3 * source_size AS cap,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER filled, 0)) * 1.0
            / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0)) AS level
  FROM weighted
  WINDOW filled AS (ORDER BY cap * 1.0 / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), CAST(max(level) OVER () AS DOUBLE) * weight) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(coalesce(budget // nullif(source_size, 0), 0) * size
         + least(greatest(budget - coalesce(budget // nullif(source_size, 0), 0) * source_size
                          - ahead, 0), size) AS BIGINT) AS taken
FROM placed
"""
