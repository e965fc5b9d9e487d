"""Near-duplicate vectors: p-stable hashing for Euclidean distance, exact checks.

Unit vectors are projected on random Gaussian directions, shifted and cut into steps;
close vectors mostly fall on the same steps. Several steps together make a bucket, and
several tables of buckets make up for unlucky cuts. The vectors of a bucket that bear
the same label are compared by their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.graph import components
from tickloom.llm.ragged import U64, groups, mix
from tickloom.llm.store import removed, written

TABLES = 20
STEPS = 8
#: Width of a step. At cosine 0.98 (distance 0.2) one bucket is shared with probability
#: 0.25 and any of 20 with 0.997; unrelated vectors share one with 3e-5.
WIDTH = 1.0
#: Members compared by one task at a time; larger buckets are cut into pairs of blocks.
BLOCK = 512


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows one after the other, and offsets; null rows are empty."""
    column = column.cast(pa.list_(pa.float64()))
    column = pa.chunked_array([column]).combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    values = column.flatten()
    return values.to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths)))


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Finite vectors times a power of two each, so that their squares neither run over nor vanish.

    The largest component comes to lie between a half and one. Cosines do not change,
    not in their last bit, as long as squares were in range before.
    """
    _, power = np.frexp(np.abs(matrix).max(axis=1, initial=0))
    half = power // 2  # in two steps: the whole power may itself be out of range
    return np.ldexp(np.ldexp(matrix, -half[:, None]), (half - power)[:, None])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and buckets of every usable vector."""
    directions: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    spread = mix(np.arange(1, TABLES * STEPS + 1, dtype=U64)).reshape(TABLES, STEPS) | U64(1)
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            part = batch.slice(lo, 2048)
            n = part.num_rows
            values, offsets = _matrix(part.column("embedding"))
            lengths = np.diff(offsets)
            labels = part.column("label")
            labelled = ~labels.is_null().to_numpy(zero_copy_only=False)
            codes = labels.fill_null(0).to_numpy().view(U64)
            digests = np.zeros((n, 2), U64)
            keys = np.zeros((n, TABLES), U64)
            usable = np.zeros(n, bool)
            for size in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero((lengths == size) & labelled)
                matrix = values[offsets[rows][:, None] + np.arange(size)]
                good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
                rows, matrix = rows[good], matrix[good]
                bits, matrix = matrix.view(U64), scaled(matrix)
                norm = np.sqrt((matrix * matrix).sum(axis=1))
                usable[rows] = True
                if size not in directions:
                    source = np.random.default_rng([7, int(size)])
                    directions[size] = source.normal(size=(size, TABLES * STEPS)), source.random(TABLES * STEPS)
                normal, shift = directions[size]
                steps = np.floor((matrix / norm[:, None]) @ normal / WIDTH + shift).astype(np.int64).view(U64)
                steps = mix(steps.reshape(-1, TABLES, STEPS) + U64(size))
                hashed = (steps * spread).sum(axis=2, dtype=U64) + mix(codes[rows])[:, None]
                keys[rows] = mix(hashed + np.arange(TABLES, dtype=U64))
                for salt in (0, 1):
                    weights = mix(np.arange(size, dtype=U64) * U64(2) + U64(salt)) | U64(1)
                    digests[rows, salt] = mix((mix(bits) * weights).sum(axis=1, dtype=U64) + mix(codes[rows]) + U64(size))
            held = np.where(usable, TABLES, 0)
            buckets = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(held))).astype(np.int32)),
                pa.array(keys[usable].ravel().view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("embedding").cast(pa.list_(pa.float64())),
                    pa.array(usable),
                    pa.array(digests[:, 0].copy().view(np.int64)),
                    pa.array(digests[:, 1].copy().view(np.int64)),
                    buckets,
                ],
                names=["vec_id", "embedding", "usable", "digest_a", "digest_b", "buckets"],
            )


def _compared(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per member of a block pair: weight of the new links, smallest node reached."""
        reps, links, roots = [], [], []
        for group in groups(batches, ["bucket", "low", "high"]):
            if group.num_rows < 2:
                continue
            ids = group.column("rep").to_numpy()
            block, low, high = (group.column(c).to_numpy() for c in ("block", "low", "high"))
            values, offsets = _matrix(group.column("embedding").combine_chunks())
            # Members of a bucket have the same number of components by its hash.
            matrix = scaled(values.reshape(len(ids), -1))
            norm = np.sqrt((matrix * matrix).sum(axis=1))
            close = (matrix @ matrix.T) / (norm[:, None] * norm) >= least
            buckets = _matrix_of_longs(group.column("buckets").combine_chunks(), len(ids))
            table = int(group.column("table")[0].as_py())
            for earlier in range(table):
                close &= buckets[:, None, earlier] != buckets[None, :, earlier]
            if low[0] == high[0]:
                np.fill_diagonal(close, False)
            else:
                close &= block[:, None] != block[None, :]
            weight = group.column("copies").to_numpy()
            found = close @ weight
            if not found.any():
                continue
            order = np.argsort(ids)
            root = np.empty(len(ids), np.int64)
            root[order] = np.arange(len(ids))
            while True:
                near = np.where(close, root[None, :], len(ids)).min(axis=1)
                fresh = np.minimum(root, near)
                fresh = np.minimum(fresh, fresh[order[fresh]])
                if (fresh == root).all():
                    break
                root = fresh
            linked = found > 0
            reps.append(ids[linked])
            links.append(found[linked])
            roots.append(ids[order[root[linked]]])
            if sum(map(len, reps)) > 4096:
                yield _linked(reps, links, roots)
                reps, links, roots = [], [], []
        if reps:
            yield _linked(reps, links, roots)

    return run


def _matrix_of_longs(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(n, -1)


def _linked(reps: list, links: list, roots: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x).astype(np.int64)) for x in (reps, links, roots)], names=["rep", "links", "root"]
    )


def near_vectors(spark: SparkSession, vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Links and groups of ``vectors (vec_id, embedding, label)`` with equal labels.

    Returns vec_id, n_links, component_id and kept for every row. Two vectors that meet
    in a bucket are linked if their cosine, in double precision, is at least ``least``.
    Equal vectors under equal labels form a class; the smallest vec_id stands for it
    and brings its number of copies. A pair is counted in the first table in which it
    meets. Buckets larger than ``BLOCK`` are cut into blocks and compared by pairs of
    blocks, each a group of its own; what a comparison returns is a count and the
    smallest member reached for each of its members, never its pairs.

    Vectors that are null, empty or zero, or that hold null or non-finite components,
    and vectors without label link with nothing, nor do vectors of different lengths. A
    row without vec_id is in no group: its component_id is null. Rows that repeat an id
    count as vectors of their own. Other columns are ignored.
    """
    # A label enters by its hash, as does a vector; 128 bits of both tell classes apart.
    code = F.when(F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string")))
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", code.alias("label"))
    hashed = written(
        spark,
        vectors.mapInArrow(
            _hashed, "vec_id long, embedding array<double>, usable boolean, digest_a long, digest_b long, buckets array<long>"
        ),
        "hashed",
    )
    full = hashed.where("usable and vec_id is not null")
    classes = written(
        spark,
        full.groupBy("digest_a", "digest_b").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    reps = full.withColumnRenamed("vec_id", "rep").join(classes, ["rep", "digest_a", "digest_b"])
    reps = reps.dropDuplicates(["rep", "digest_a", "digest_b"])
    spots = reps.select("rep", "digest_a", "digest_b", F.posexplode("buckets").alias("table", "bucket"))
    crowded = spots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    spots = written(spark, spots.join(crowded, "bucket"), "spots")
    # A repeated id may stand for several classes: its rows are told apart by digest.
    carried = reps.select("rep", "digest_a", "digest_b", "copies", "buckets", "embedding")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    placed = (
        spots.withColumn("block", block)
        .select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("rep", "digest_a", "digest_b", "table", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .join(carried, ["rep", "digest_a", "digest_b"])
    )
    dealt = placed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    found = written(
        spark, dealt.mapInArrow(_compared(least), "rep long, links long, root long"), "found"
    )
    groups = components(spark, found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labelled = (
        classes.join(counted, "rep", "left")
        .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "digest_a",
            "digest_b",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("linked"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    joined = hashed.select("vec_id", "usable", "digest_a", "digest_b").join(labelled, ["digest_a", "digest_b"], "left")
    known = F.col("usable") & F.col("vec_id").isNotNull()
    removed(spark, spots)
    return joined.select(
        "vec_id",
        F.when(known, F.col("linked")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.when(known, F.col("component")).otherwise(F.col("vec_id"))).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
