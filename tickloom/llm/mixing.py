"""Mixing sources to target weights, with DataFrame functions only.

Every text gets a hash-random key. The texts of a source are cut into key ranges; the
words of all ranges before a text's own, plus those before it in its range, say how far
into the source's random order it stands, and the source's budget is cut there.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.store import written

#: Of the sources by code point, null last; repeating.
WEIGHTS = (5, 2, 1)
#: The size of the mix against that of all texts, as a fraction.
SHARE = (3, 2)
#: No source, and no text, is taken more often than this.
REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size and target of each source of ``sized (source, size)``.

    Sources are filled in the order in which they would reach their limit; the first
    that does not reach it sets the level of all later ones. One row per source is
    brought together, no more.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("w", weight)
    full = (F.col("source_size") * lcm(*weights) / F.col("w")).cast("decimal(38,0)")
    by_limit = Window.partitionBy(F.lit(0)).orderBy(full, F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    up, down = SHARE
    wide = "decimal(38,0)"
    total = F.sum("source_size").over(everything)
    filled = F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    # Words left to give, times ``down``; the limits before this source's are used up.
    left = (up * total - down * REPEATS * filled).cast(wide)
    stated = sources.select(
        "source",
        "source_size",
        "w",
        left.alias("left"),
        open_weight.alias("open_weight"),
        (left * F.col("w") >= F.col("source_size").cast(wide) * (down * REPEATS) * open_weight).alias("limited"),
    )
    level = F.max(F.when(~F.col("limited"), F.struct("open_weight", "left"))).over(everything)
    target = F.when(F.col("limited"), (F.col("source_size") * REPEATS).cast("double")).otherwise(
        (F.col("w") * level["left"]).cast("double") / (level["open_weight"] * down).cast("double")
    )
    return stated.select("source", "source_size", target.alias("target"))


def mix_sources(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs``.

    ``docs`` has doc_id, text and source. Whole passes over a source are taken as long
    as its budget (its target, rounded down) holds them; the rest is filled in random
    order, and the text at the border is taken in part, so that every source's taken
    words are its budget exactly. The order comes from a hash of id and size: reruns
    agree, and rows equal in both are interchangeable.

    Null texts have size 0 and take nothing; a null source is a source, the last one; a
    null id is hashed as such. Sources without words have target 0. Each row gives a
    row, an empty table none; very long texts only count their words, in one pass. Other
    columns are ignored. Targets rest on ``decimal(38,0)`` arithmetic.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size"))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sized = written(spark, sized.withColumn("key", key), "sized")
    # As many ranges as a range has rows, so that neither grows with the input itself.
    n_ranges = int(max(1, sized.count()) ** 0.5) + 1
    point = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    ranged = sized.select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("place"),
        F.floor(point * n_ranges / float(1 << 32)).alias("range"),
    )
    sums = ranged.groupBy("place", "source", "range").agg(F.sum("size").alias("words"))
    targets = source_targets(sized, weights).withColumn(
        "place", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    )
    earlier = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .drop("source")
        .join(targets.drop("source"), "place")
        .select("place", "range", "before", "source_size", "target")
    )
    within = Window.partitionBy("place", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(starts, ["place", "range"]).withColumn(
        "before", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - passes * F.col("source_size")
    partly = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * passes + partly).cast("long").alias("taken")
    )


#: The rows of :func:`mix_sources` over ``documents``, in DuckDB's SQL.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, size, md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', CAST(size AS VARCHAR))) AS key
  FROM (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM {documents})
), sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::HUGEINT AS w
  FROM sized GROUP BY source
), stated AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER before, 0) AS words_left,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open_weight
  FROM sources
  WINDOW before AS (ORDER BY source_size * 10 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), limited AS (
  SELECT *, words_left * w >= source_size * 4 * open_weight AS at_limit FROM stated
), level AS (
  SELECT arg_max(words_left, open_weight) AS words_left, max(open_weight) AS open_weight FROM limited WHERE NOT at_limit
), targets AS (
  SELECT l.source, l.source_size::BIGINT AS source_size,
         CASE WHEN l.at_limit THEN (l.source_size * 2)::DOUBLE
              ELSE (l.w * v.words_left)::DOUBLE / (v.open_weight * 2)::DOUBLE END AS target
  FROM limited l, level v
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passed AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM placed
)
SELECT doc_id, size, source_size, target,
       (size * passes + greatest(0, least(size, budget - passes * source_size - before)))::BIGINT AS taken
FROM passed
"""
