"""How filters of a corpus interact: survivors, removals and redundancy in any order.

Every filter's failing documents are stored as a table of their ids. What a filter
removes after others is its table left-anti joined with theirs; what survives a set of
filters is the corpus left-anti joined with the tables of the set. Both depend on the
set that went before only, not on its order, so all orders follow from the 2^n sets.
All joins are on the document, so they share one exchange of narrow rows per table.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.store import written

#: What separates words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
#: How a document is known in the id tables: its id (0 without one) and what tells
#: apart rows under one id, among them those that have none.
KEY = ["id", "mark"]

#: A failure condition over the column ``text``, or a function from the keyed
#: documents to the keys of those that fail.
Filter = Column | Callable[[DataFrame], DataFrame]


def standard_filters() -> dict[str, Filter]:
    """The five filters of the audit, as failure conditions on the column ``text``."""
    words = F.array_remove(F.split("text", BLANKS), "")
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
        "E": repeated_texts,
    }


def repeated_texts(judged: DataFrame) -> DataFrame:
    """Keys of the documents whose text stands under a smaller doc_id as well.

    The first ids of the texts are an aggregate; a document fails if it is none of them.
    That takes a join on the document, never one on the text, however often it repeats.
    """
    named = judged.where("named")
    firsts = named.groupBy("digest").agg(F.min("id").alias("id"))
    return named.join(firsts, ["id", "digest"], "left_anti").select(*KEY)


def failing_ids(spark: SparkSession, docs: DataFrame, filters: dict[str, Filter]) -> tuple[DataFrame, DataFrame]:
    """The keyed documents (id, mark, part) and the id tables: (id, mark) by ``filter``.

    The id tables are one written table, filed by filter, so that reading one filter
    reads its files alone.
    """
    plain = {name: test for name, test in filters.items() if isinstance(test, Column)}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    failed = [F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in plain.items()]
    judged = written(
        spark,
        source.select(
            F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
            F.xxhash64("text", F.col("doc_id").isNull()).alias("mark"),
            F.col("doc_id").isNotNull().alias("named"),
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.array_compact(F.array(*failed)).cast("array<string>").alias("failed"),
        ),
        "judged",
    )
    found = judged.select(*KEY, F.explode("failed").alias("filter"))
    for name, test in filters.items():
        if name not in plain:
            found = found.unionByName(test(judged).select(*KEY, F.lit(name).alias("filter")))
    # A repeated row fails with its twin: ids are needed once for the joins, but rows
    # are counted as often as they stand in the corpus, so nothing is made distinct.
    return judged.select(*KEY, "named", "part"), written(spark, found, "failing", by="filter")


def _without(rows: DataFrame, tables: dict[str, DataFrame], sets: str, skip: Column | None = None) -> DataFrame:
    """``rows`` once for every set of filters, less what a filter of the set removes.

    ``sets`` numbers the sets by bits. One left-anti join per filter: rows that took
    the filter into their set look for themselves in its table, the others pass.
    """
    rows = rows.withColumn(sets, F.lit(0))
    for bit, (name, table) in enumerate(tables.items()):
        own = F.lit(False) if skip is None else skip == bit
        both = F.when(own, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
        rows = rows.withColumn("taken", F.explode(both)).alias("r")
        failing = table.alias("f")
        same = [F.col(f"r.{k}") == F.col(f"f.{k}") for k in KEY] + [F.col("r.taken") == 1]
        rows = rows.join(failing, same, "left_anti")
        rows = rows.withColumn(sets, F.col(sets) + F.col("taken") * (1 << bit)).drop("taken")
    return rows


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] | None = None) -> DataFrame:
    """What each of ``filters`` does at every step of every order of all of them.

    ``docs (doc_id, text, lang)`` are counted by ``part``, their ``lang``. Returns part,
    filter_order, step and the counts kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, for every part and step, zeros included. Losses are removed
    documents that ``labels (doc_id, quality, toxic)`` mark 1.

    Null texts are empty, a null lang is the part ``''``. Very long texts are taken
    whole, one at a time. Every row of ``docs`` counts: rows that repeat an id, and
    those without id, are judged by their own text, and only texts under a smaller id
    make a text repeated, so rows without id neither repeat a text nor are repeated
    ones, and equal rows under one id do not repeat each other. A label that is null
    or absent is no loss; of several rows of labels under one id, one that says 1 is
    enough. An empty ``docs`` has no part, so no rows. Other columns are ignored.

    With n filters each document is looked up in 2^n sets: n is meant to be small.
    """
    filters = filters or standard_filters()
    names = list(filters)
    everyone, failing = failing_ids(spark, docs, filters)
    tables = {name: failing.where(F.col("filter") == name).select(*KEY) for name in names}

    marked = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("id"))
    marked = marked.agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    # A row without id goes by 0 in the id tables, but has no labels.
    labelled = everyone.withColumn("labelled", F.when(F.col("named"), F.col("id"))).join(
        marked.withColumnRenamed("id", "labelled"), "labelled", "left"
    )

    survivors = _without(everyone.drop("named"), tables, "after").groupBy("part", "after").agg(F.count("*").alias("kept"))
    removed = None
    for bit, name in enumerate(names):
        fails = labelled.join(tables[name], KEY, "left_semi").withColumn("own", F.lit(bit))
        removed = fails if removed is None else removed.unionByName(fails)
    removed = (
        _without(removed, tables, "before", F.col("own"))
        .groupBy("part", "own", "before")
        .agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    )
    return _in_all_orders(spark, names, written(spark, survivors, "survivors"), written(spark, removed, "removed"))


def _in_all_orders(spark: SparkSession, names: list[str], survivors: DataFrame, removed: DataFrame) -> DataFrame:
    """The counts of each set, told for every step of every order."""
    n, whole = len(names), (1 << len(names)) - 1
    # Two tables of 2^n n and n! n rows, whatever the corpus.
    sets = [(own, s, factorial(bin(s).count("1")) * factorial(n - 1 - bin(s).count("1"))) for own in range(n) for s in range(whole + 1) if not s >> own & 1]
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, own in enumerate(order, 1):
            steps.append(("".join(names[k] for k in order), step, own, before, before | 1 << own))
            before |= 1 << own
    sets = spark.createDataFrame(sets, "own int, before int, orders long")
    steps = spark.createDataFrame(steps, "filter_order string, step int, own int, before int, after int")

    zero = F.lit(0).cast("long")
    parts = survivors.where("after = 0").select("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("own"))
    lattice = parts.join(F.broadcast(sets), "own").join(removed, ["part", "own", "before"], "left").fillna(0)
    alone = lattice.groupBy("part", "own").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.max(F.when(F.col("before") + F.expr("shiftleft(1, own)") == whole, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"),
    )
    told = lattice.join(alone, ["part", "own"]).join(F.broadcast(steps), ["own", "before"])
    told = told.join(survivors, ["part", "after"], "left")
    return told.select(
        "part",
        "filter_order",
        "step",
        F.coalesce("kept", zero).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


ORACLE = r"""
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), judged AS (
  SELECT d.part,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e,
    coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM worded d LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id
), patterns AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM judged GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x)
, orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
), steps AS (
  SELECT filter_order, step::INT AS step, (1 << (ascii(filter_order[step]) - 65))::INT AS own,
         coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS before
  FROM orders, range(1, 6) AS g(step)
), told AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN fails & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM patterns, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
"""
