"""The audit of filters against a count by hand over every order."""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import functions as F

from tickloom.llm import audit

LONG = " ".join(f"w{k}" for k in range(260))


def by_hand(docs, labels, names, fails):
    """Counts per part, order and step; ``fails`` gives the failing set of every row."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    found, shapley = {}, {}
    for order in permutations(names):
        left = list(range(len(docs)))
        for step, name in enumerate(order, 1):
            for part in {d[2] or "" for d in docs}:
                mine = [k for k in range(len(docs)) if (docs[k][2] or "") == part]
                here = [k for k in mine if k in left and name in fails[k]]
                found[part, "".join(order), step] = [
                    len([k for k in mine if k in left and name not in fails[k]]),
                    len(here),
                    len([k for k in mine if name in fails[k] and k not in left]),
                    len([k for k in mine if fails[k] == {name}]),
                    len([k for k in here if docs[k][0] in good]),
                    len([k for k in here if docs[k][0] in toxic]),
                ]
                shapley[part, name] = shapley.get((part, name), 0) + len(here)
            left = [k for k in left if name not in fails[k]]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in found.items()}


def told(frame):
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = frame.collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in counts) for r in rows}
    assert len(got) == len(rows)
    return got


def standard_fails(docs):
    fails = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        mine = set()
        if len(words) < 200:
            mine.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            mine.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            mine.add("C")
        if re.search("[#$%&*|]", text):
            mine.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs):
            mine.add("E")
        fails.append(mine)
    return fails


DOCS = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (2, LONG, "en"),  # the same row twice
    (2, LONG + " #", "fr"),  # another text under the same id
    (3, "a " * 500, "en"),
    (4, "A B C", "fr"),
    (5, None, "en"),
    (6, "", None),
    (7, "\t\n ", None),
    (0, "x", "de"),
    (None, LONG, "en"),
    (None, LONG, "en"),
    (None, "x", "de"),
    (8, "é" * 40 + "A\x0b" * 3 + " ", ""),
    (9, "A B C", "fr"),
    (-3, ("Word " * 90_000) + "| end", "en"),
]
LABELS = [(1, 1, 0), (2, 0, None), (2, 1, 1), (3, None, 1), (0, 1, 1), (None, 1, 1), (5, 1, 0), (99, 1, 1), (9, 1, 1)]


def frames(spark, docs=DOCS, labels=LABELS):
    extra = {"id": F.lit(7), "mark": F.lit("m"), "part": F.lit("p"), "good": F.lit(1), "failed": F.lit(None).cast("string")}
    found = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5).withColumns(extra)
    return found, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"id": F.lit(1), "text": F.lit("t")})


def test_audit_of_odd_rows_equals_a_count_by_hand(spark):
    got = told(audit.audit(spark, *frames(spark)))
    assert got == by_hand(DOCS, LABELS, "ABCDE", standard_fails(DOCS))
    assert len(got) == 600 * 4


def test_audit_of_other_filters(spark):
    filters = {
        "x": F.col("text").contains("#"),
        "y": F.lit(None).cast("boolean"),  # unknown is no failure
        "z": F.length("text") > 100,
    }
    docs, labels = frames(spark)
    fails = [{n for n, hit in (("x", "#" in (t or "")), ("z", len(t or "") > 100)) if hit} for _, t, _ in DOCS]
    assert told(audit.audit(spark, docs, labels, filters)) == by_hand(DOCS, LABELS, "xyz", fails)


def test_audit_of_empty_tables(spark):
    docs, labels = frames(spark)
    assert audit.audit(spark, docs.limit(0), labels).count() == 0
    assert told(audit.audit(spark, docs, labels.limit(0))) == by_hand(DOCS, [], "ABCDE", standard_fails(DOCS))


def test_audit_of_one_text_in_most_rows_joins_on_documents_only(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(0).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    everyone, failing = audit.failing_ids(spark, docs, audit.standard_filters())
    assert failing.where("filter = 'E'").count() == 2665
    plan = audit.repeated_texts(everyone.withColumn("digest", F.col("mark")))._jdf.queryExecution().toString()
    assert "LeftAnti" in plan
    got = told(audit.audit(spark, docs, labels))
    assert got["en", "EABCD", 1][:2] == (1335, 2665)
    assert got["en", "AEBCD", 2][1:3] == (0, 2665)
