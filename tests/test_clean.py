import random

from tickloom.operators.clean import distinct_bars, last_write_wins, ordering, settle_revisions, union_bars
from tickloom.schema import empty_bars
from tests.support import at, make_bars

ROWS = [("A", "2024-01-01T10:00:00", 1.0), ("A", "2024-01-01T11:00:00", 2.0), ("B", "2024-01-01T10:00:00", 3.0)]


def test_exact_copies_become_one(spark):
    bars = make_bars(spark, ROWS + ROWS[:1] * 500)
    assert sorted(distinct_bars(bars).collect()) == sorted(make_bars(spark, ROWS).collect())


def test_copies_meet_before_the_shuffle(spark):
    plan = distinct_bars(make_bars(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_distinct_keeps_revisions(spark):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", 1.0), ("A", "2024-01-01T10:00:00", 2.0)])
    assert distinct_bars(bars).count() == 2


def test_empty_is_the_identity_of_union(spark):
    bars = make_bars(spark, ROWS)
    joined = union_bars(empty_bars(spark), bars, empty_bars(spark))
    assert joined.schema == bars.schema and sorted(joined.collect()) == sorted(bars.collect())


def revisions(spark, rows):
    return spark.createDataFrame(
        [("A", at("2024-01-01T10:00:00"), c, c, c, c, 1.0, at(seen)) for c, seen in rows],
        "stock string, date timestamp, open double, high double, low double, close double, "
        "volume double, ingest_ts timestamp",
    )


def test_the_revision_ingested_last_wins_whatever_the_row_order(spark):
    rows = [(float(i), f"2024-01-01T10:00:{i:02d}") for i in range(30)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        settled = settle_revisions(revisions(spark, rows).repartition(4)).collect()
        assert [r.close for r in settled] == [29.0]


def test_further_columns_break_ties(spark):
    rows = [(c, "2024-01-01T10:00:00") for c in (1.0, 3.0, 2.0)]
    settled = settle_revisions(revisions(spark, rows), ["ingest_ts", "close"])
    assert settled.first().close == 3.0


def test_one_order_column_keeps_a_hash_aggregate(spark):
    frame = settle_revisions(revisions(spark, [(1.0, "2024-01-01T10:00:00")]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


PAIRS = [
    (None, None), (None, -5), (None, 7), ("0001-01-01T00:00:00", 2**63 - 1), ("1969-12-31T23:59:59", -(2**63)),
    ("1969-12-31T23:59:59", None), ("2024-01-01T10:00:00", 0), ("2024-01-01T10:00:00", 2**63 - 1),
    ("2024-01-01T10:00:00.000001", -(2**63)), ("9999-12-31T23:59:59", None), ("9999-12-31T23:59:59", 1),
]


def ordered(spark):
    rows = [("k", None if when is None else at(when), n, float(i)) for i, (when, n) in enumerate(PAIRS)]
    return spark.createDataFrame(rows, "k string, t timestamp, n bigint, v double")


def test_an_instant_and_a_number_order_like_the_pair(spark):
    rank = ordering(["t", "n"], ordered(spark).schema)
    by_rank = [r.v for r in ordered(spark).orderBy(rank).select("v").collect()]
    by_pair = [r.v for r in ordered(spark).orderBy("t", "n").select("v").collect()]
    assert by_rank == by_pair
    assert ordered(spark).select(rank.alias("r")).distinct().where("r is not null").count() == len(PAIRS)


def test_two_instants_order_like_the_pair(spark):
    frame = ordered(spark).selectExpr("k", "t", "timestamp_seconds(n % 100000) u", "v")
    by_rank = [r.v for r in frame.orderBy(ordering(["t", "u"], frame.schema), "v").select("v").collect()]
    assert by_rank == [r.v for r in frame.orderBy("t", "u", "v").select("v").collect()]


def test_an_instant_and_a_number_keep_a_hash_aggregate(spark):
    frame = last_write_wins(ordered(spark), ["k"], ["t", "n"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert frame.select("v").first().v == 10.0


def test_a_null_value_of_the_last_write_is_kept(spark):
    frame = spark.createDataFrame([("k", 1, 5.0), ("k", 2, None)], "k string, n int, v double")
    assert last_write_wins(frame, ["k"], ["n"]).first().v is None


def test_rows_without_an_order_lose_to_others_but_are_not_lost(spark):
    frame = spark.createDataFrame(
        [("a", None, 5.0), ("a", 1, 6.0), ("b", None, 7.0)], "k string, n int, v double"
    )
    got = last_write_wins(frame, ["k"], ["n"]).collect()
    assert sorted((r.k, r.n, r.v) for r in got) == [("a", 1, 6.0), ("b", None, 7.0)]
