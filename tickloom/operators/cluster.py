"""K-means groups of stocks over their average bar."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.stats import AVERAGE_FIELDS
from tickloom.session import run_dir, shared_dir

#: Cells of a coreset, at most and about; the fit holds so many short vectors.
CELLS = 20_000
#: Steps per feature that are tried for a coreset, the finest first.
STEPS = [2**n for n in range(14, 0, -1)]


@dataclass(frozen=True)
class Clustering:
    """Labels per stock, the centres in label order, and the stocks left out."""

    labels: DataFrame
    centres: list[list[float]]
    skipped: DataFrame
    cost: float


def _usable() -> Column:
    """Whether all averages of a stock are numbers."""
    return reduce(and_, (F.col(name).isNotNull() & ~F.isnan(name) for name in AVERAGE_FIELDS))


def unusable_features(summary: DataFrame) -> DataFrame:
    """Stocks that cannot be placed because an average is null or NaN."""
    return summary.where(~_usable())


def assemble_features(summary: DataFrame) -> DataFrame:
    """Stock and feature vector of the five averages; unusable stocks are skipped."""
    assembler = VectorAssembler(
        inputCols=AVERAGE_FIELDS, outputCol="features", handleInvalid="skip"
    )
    return assembler.transform(summary).select("stock", "features")


def cluster_stocks(
    summary: DataFrame, k: int = 3, seed: int = 1, scale: bool = False, parts: int = 32
) -> Clustering:
    """Fit k-means on one vector per stock and label every stock.

    The vectors are written to the checkpoint folder first: the fit passes over
    them many times and must not redo the scan of the bars, nor lose them with an
    executor. Rows are dealt by stock to ``parts`` partitions and ordered there; the fit
    starts from a sample per partition, so the same data give the same start whatever
    the session's partition count. Labels are numbered by ascending centre; only
    the centres, k short vectors, come to the driver.
    """
    spark = summary.sparkSession
    shared_dir(spark)
    features = assemble_features(summary)
    features = features.repartition(parts, "stock").sortWithinPartitions("stock").checkpoint()
    skipped = unusable_features(summary)
    if features.isEmpty():
        labels = spark.createDataFrame([], "stock string, prediction int")
        return Clustering(labels, [], skipped, 0.0)
    if scale:
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
        scaled = scaler.fit(features).transform(features)
        features = scaled.select("stock", F.col("scaled").alias("features"))
    # The row solver copes with fewer distinct vectors than groups; the block one fails.
    model = KMeans(k=k, seed=seed, featuresCol="features", solver="row").fit(features)
    centres = [[float(x) for x in centre] for centre in model.clusterCenters()]
    rank = sorted(range(len(centres)), key=centres.__getitem__)
    renumber = F.create_map(
        *[F.lit(part) for new, old in enumerate(rank) for part in (old, new)]
    )
    labels = model.transform(features).select(
        "stock", renumber[F.col("prediction")].alias("prediction")
    )
    return Clustering(
        labels, [centres[old] for old in rank], skipped, model.summary.trainingCost
    )


def coreset(summary: DataFrame, cells: int = CELLS) -> DataFrame:
    """Weighted vectors that stand for all usable ones: the means of cells of a grid.

    The range of every average is cut into steps of one length, as many as keep the
    cells below about ``cells``; how many there would be at each step is estimated for
    all steps in one pass. A cell's number and sums are plain aggregates, so cells of
    parts of the data merge, and neither the order of rows nor their partitions enter.
    Returns ``weight`` and the averages; cells are rounded to ten digits of their range, so
    that the order of additions does not show.
    """
    rows = summary.where(_usable()).select(*AVERAGE_FIELDS)
    ends = rows.agg(*(f(name).alias(f"{f.__name__}_{name}") for name in AVERAGE_FIELDS for f in (F.min, F.max))).first()
    low = {name: ends[f"min_{name}"] for name in AVERAGE_FIELDS}
    wide = {name: (ends[f"max_{name}"] or 0) - (ends[f"min_{name}"] or 0) for name in AVERAGE_FIELDS}
    if low[AVERAGE_FIELDS[0]] is None:
        return rows.withColumn("weight", F.lit(1.0)).limit(0)

    def place(name: str, steps: int):
        part = (F.col(name) - F.lit(low[name])) / F.lit(wide[name] or 1.0)
        return F.least(F.floor(part * steps), F.lit(steps - 1))

    counts = rows.agg(*(F.approx_count_distinct(F.struct(*(place(n, s) for n in AVERAGE_FIELDS)), 0.02) for s in STEPS)).first()
    steps = next((s for s, n in zip(STEPS, counts) if n <= cells), STEPS[-1])
    # Sums from the low end keep their digits; the mean is rounded to a share of the range.
    means = [
        (F.round(F.avg((F.col(n) - F.lit(low[n])) / F.lit(wide[n] or 1.0)), 10) * F.lit(wide[n]) + F.lit(low[n])).alias(n)
        for n in AVERAGE_FIELDS
    ]
    grouped = rows.groupBy(*(place(n, steps).alias(f"at_{n}") for n in AVERAGE_FIELDS))
    return grouped.agg(F.count("*").cast("double").alias("weight"), *means).select("weight", *AVERAGE_FIELDS)


def cluster_by_coreset(summary: DataFrame, k: int = 3, seed: int = 1, cells: int = CELLS) -> Clustering:
    """:func:`cluster_stocks` for many stocks: the fit passes over a coreset only.

    The coreset, of a bounded number of rows, is put in one order in one partition, so
    the same data give the same centres however they are partitioned. Every stock is
    then labelled in one pass over the summary, by the nearest centre. The cost is that
    of all stocks.
    """
    spark = summary.sparkSession
    shared_dir(spark)
    path = run_dir(spark, "coreset")
    coreset(summary, cells).coalesce(1).sortWithinPartitions(*AVERAGE_FIELDS).write.parquet(path)
    cut = spark.read.parquet(path)
    skipped = unusable_features(summary)
    if cut.isEmpty():
        return Clustering(spark.createDataFrame([], "stock string, prediction int"), [], skipped, 0.0)
    vectors = VectorAssembler(inputCols=AVERAGE_FIELDS, outputCol="features").transform(cut)
    fitted = vectors.coalesce(1).sortWithinPartitions(*AVERAGE_FIELDS).select("weight", "features").checkpoint()
    model = KMeans(k=k, seed=seed, featuresCol="features", weightCol="weight", solver="row").fit(fitted)
    centres = sorted([float(x) for x in centre] for centre in model.clusterCenters())
    apart = [sum((F.col(n) - F.lit(x)) ** 2 for n, x in zip(AVERAGE_FIELDS, centre)) for centre in centres]
    placed = summary.where(_usable())
    nearest = F.array_min(F.array(*apart))
    placed = placed.select("stock", (F.array_position(F.array(*apart), nearest) - 1).cast("int").alias("prediction"), nearest.alias("apart"))
    cost = placed.agg(F.sum("apart")).first()[0]
    return Clustering(placed.drop("apart"), centres, skipped, float(cost or 0.0))
