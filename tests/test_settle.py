import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.settle import settle_by

SCHEMA = "k string, name string, n int, note string, x double, v string"


def made_up(seed: int, n: int = 300):
    source = random.Random(seed)
    texts = [None, "", "a", "a\0", "ab", "b", "é", "z" * 5000, "z" * 5000 + "a", "𝄞", "￮"]
    return [
        (
            source.choice(["p", "q", None, "r"]),
            source.choice(texts),
            source.choice([None, -1, 0, 7]),
            source.choice(texts),
            source.choice([None, -0.5, 2.0, float("nan"), float("inf")]),
            f"v{i}",
        )
        for i in range(n)
    ]


def place(value):
    """Null first, NaN last, text by its bytes, as Spark sorts."""
    if value is None:
        return (0,)
    if value != value:
        return (2,)
    return (1, value.encode() if isinstance(value, str) else value)


@pytest.mark.parametrize("order", [["name", "n", "note"], ["n", "x", "name"], ["x"], ["note", "name", "n", "x"]])
def test_the_last_row_by_any_columns(spark, order):
    rows = made_up(len(order))
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    at = [names.index(name) for name in order]
    best = {}
    for row in rows:
        rank = [place(row[i]) for i in at]
        best.setdefault(row[0], []).append((rank, row))
    top = {key: max(rank for rank, _ in own) for key, own in best.items()}
    got = settle_by(spark.createDataFrame(rows, SCHEMA).repartition(7), ["k"], order).collect()
    assert len(got) == len(top) == len({r.k for r in got})
    for r in got:
        assert [place(r[i]) for i in at] == top[r.k]
        assert any([place(x) for x in row] == [place(x) for x in r] for _, row in best[r.k])


def test_ties_give_the_same_row_in_every_run_and_copies_one(spark):
    rows = [("p", "a", 1, None, 0.0, f"v{i % 20}") for i in range(200)] + [("q", "a", 1, None, 0.0, "same")] * 50
    frame = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(settle_by(frame.repartition(n), ["k"], ["name", "n"]).collect()) for n in (1, 5)]
    assert runs[0] == runs[1] and [r.k for r in runs[0]] == ["p", "q"]


def test_no_key_no_rows_and_names_in_use(spark):
    frame = spark.createDataFrame(made_up(9, 40), SCHEMA)
    assert settle_by(frame.limit(0), ["k"], ["name", "n"]).count() == 0
    clash = frame.withColumn("_rank", F.lit(1)).withColumn("_kept_k", F.lit("x"))
    assert settle_by(clash, ["k"], ["name", "_rank", "_kept_k"]).columns == clash.columns
    clash = frame.withColumnsRenamed({"k": "digest_1", "x": "c0"})
    assert settle_by(clash, ["digest_1"], ["name", "c0"]).count() == 4


def test_days_flags_and_keys_of_two_columns(spark):
    rows = [(1, "a", dt.date(2024, 1, d % 5 + 1), d % 2 == 0, d) for d in range(20)] + [(1, None, None, None, 99)]
    frame = spark.createDataFrame(rows, "i int, k string, day date, flag boolean, v int")
    got = {(r.i, r.k): (r.day, r.flag) for r in settle_by(frame, ["i", "k"], ["day", "flag"]).collect()}
    assert got == {(1, "a"): (dt.date(2024, 1, 5), True), (1, None): (None, None)}


def test_only_hash_aggregates(spark, monkeypatch):
    from tickloom.operators import settle

    plans, stored = [], settle._stored

    def watched(rows, label):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stored(rows, label)

    monkeypatch.setattr(settle, "_stored", watched)
    settled = settle_by(spark.createDataFrame(made_up(4), SCHEMA), ["k"], ["name", "n", "note"])
    plans.append(settled._jdf.queryExecution().executedPlan().toString())
    # Tuples, ranks of two texts, five stages, the result: none has another's plan within it.
    assert len(plans) == 9 and not any("SortAggregate" in plan for plan in plans)
    assert all("HashAggregate" in plan and plan.count("Exchange") <= 8 for plan in plans)
