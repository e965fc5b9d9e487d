import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators.cluster import assemble_features, cluster_by_coreset, cluster_stocks, coreset
from tickloom.operators.stats import AVERAGE_FIELDS, stock_summary
from tickloom.schema import empty_bars
from tests.support import make_bars

SCHEMA = "stock string, " + ", ".join(f"{name} double" for name in AVERAGE_FIELDS)


def summary(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def blobs(spark, parts):
    pick = random.Random(5)
    rows = [
        (f"S{i}", *[100.0 * (i % 3) + pick.uniform(-1, 1) for _ in AVERAGE_FIELDS])
        for i in range(60)
    ]
    return summary(spark, rows).repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_separate_groups_are_found_and_numbered_by_centre(spark, parts):
    got = cluster_stocks(blobs(spark, parts))
    labels = {r.stock: r.prediction for r in got.labels.collect()}
    assert labels == {f"S{i}": i % 3 for i in range(60)}
    assert got.centres == sorted(got.centres) and got.skipped.count() == 0


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def test_every_stock_is_at_its_nearest_centre(spark):
    pick = random.Random(7)
    rows = [(f"S{i}", *[pick.uniform(0, 10) for _ in AVERAGE_FIELDS]) for i in range(80)]
    got = cluster_stocks(summary(spark, rows))
    labels = {r.stock: r.prediction for r in got.labels.collect()}
    assert len(labels) == 80 and set(labels.values()) == {0, 1, 2}
    cost = 0.0
    for stock, *point in rows:
        distances = [distance(point, c) for c in got.centres]
        assert labels[stock] == distances.index(min(distances))
        cost += min(distances)
    mean = [sum(column) / 80 for column in zip(*[r[1:] for r in rows])]
    assert cost == pytest.approx(got.cost) and cost < sum(distance(r[1:], mean) for r in rows)


def test_same_input_same_labels(spark):
    pick = random.Random(9)
    rows = [(f"S{i}", *[pick.uniform(0, 10) for _ in AVERAGE_FIELDS]) for i in range(50)]
    runs = [sorted(cluster_stocks(summary(spark, rows)).labels.collect()) for _ in range(2)]
    assert runs[0] == runs[1]


def test_unusable_stocks_are_skipped_and_listed(spark):
    rows = [(f"S{i}", *[float(i)] * 5) for i in range(6)]
    rows += [("gap", 1.0, None, 1.0, 1.0, 1.0), ("nan", 1.0, float("nan"), 1.0, 1.0, 1.0)]
    got = cluster_stocks(summary(spark, rows))
    assert sorted(r.stock for r in got.skipped.collect()) == ["gap", "nan"]
    assert got.labels.count() == 6
    assert assemble_features(summary(spark, rows)).count() == 6


def test_fewer_stocks_than_groups(spark):
    got = cluster_stocks(summary(spark, [("A", *[1.0] * 5), ("B", *[9.0] * 5)]))
    assert sorted((r.stock, r.prediction) for r in got.labels.collect()) == [("A", 0), ("B", 1)]


def test_fewer_different_stocks_than_groups(spark):
    rows = [(f"S{i}", *[float(i % 2)] * 5) for i in range(10)]
    got = cluster_stocks(summary(spark, rows))
    assert {r.stock: r.prediction for r in got.labels.collect()} == {r[0]: int(r[1]) for r in rows}


def test_empty_in_empty_out(spark):
    got = cluster_stocks(stock_summary(empty_bars(spark)))
    assert got.labels.count() == 0 and got.labels.columns == ["stock", "prediction"]


def test_scaling_keeps_volume_from_deciding_alone(spark):
    rows = [(f"S{i}", *[float(i % 2)] * 4, 1e6 * (i % 3)) for i in range(12)]
    by_price = cluster_stocks(summary(spark, rows), k=2, scale=True)
    price = {r[0]: r[1] for r in rows}
    labels = {r.stock: float(r.prediction) for r in by_price.labels.collect()}
    assert labels == price


def test_from_bars(spark):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", 1.0), ("B", "2024-01-01T10:00:00", 50.0)])
    assert cluster_stocks(stock_summary(bars), k=2).labels.count() == 2


@pytest.mark.parametrize("shuffles", ["4", "8", "17"])
def test_labels_do_not_depend_on_the_partition_count(spark, shuffles):
    pick = random.Random(11)
    rows = [(f"S{i}", *[pick.uniform(0, 10) for _ in AVERAGE_FIELDS]) for i in range(90)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = sorted(cluster_stocks(summary(spark, rows)).labels.collect())
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mixed = summary(spark, rows).repartition(int(shuffles), "stock")
        assert sorted(cluster_stocks(mixed).labels.collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def averages(spark, n, seed=1):
    source = np.random.default_rng(seed)
    centres = np.array([[10, 11, 9, 10, 500], [50, 52, 48, 51, 2000], [90, 95, 85, 92, 9000]], float)
    values = centres[source.integers(3, size=n)] + source.normal(size=(n, 5)) * [2, 2, 2, 2, 90]
    return [(f"S{k}", *map(float, v)) for k, v in enumerate(values)]


def test_a_coreset_gives_the_same_labels_for_any_partitions_and_near_the_full_cost(spark):
    rows = averages(spark, 3000)
    whole = cluster_stocks(spark.createDataFrame(rows, SCHEMA))
    found = []
    for parts in (1, 7, 23):
        groups = cluster_by_coreset(spark.createDataFrame(rows, SCHEMA).repartition(parts), cells=200)
        found.append((sorted(map(tuple, groups.labels.collect())), groups.centres))
        assert groups.cost <= 1.05 * whole.cost
    assert found[0] == found[1] == found[2]
    assert found[0][0] == sorted(map(tuple, whole.labels.collect()))


def test_coresets_are_bounded_and_take_odd_rows(spark):
    frame = spark.createDataFrame(averages(spark, 4000, 2), SCHEMA)
    small = coreset(frame, 150)
    assert small.count() <= 170 and small.agg(F.sum("weight")).first()[0] == 4000
    odd = spark.createDataFrame([("a", *[1.0] * 5), ("b", *[1.0] * 5), ("c", None, *[1.0] * 4), ("d", float("nan"), *[1.0] * 4)], SCHEMA)
    groups = cluster_by_coreset(odd)
    assert sorted(map(tuple, groups.labels.collect())) == [("a", 0), ("b", 0)]
    assert sorted(r.stock for r in groups.skipped.collect()) == ["c", "d"]
    assert cluster_by_coreset(odd.limit(0)).labels.count() == 0
