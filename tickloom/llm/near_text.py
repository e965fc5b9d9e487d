"""Near-duplicate texts: SuperMinHash signatures, banding, verification, union-find.

The element hashes of a text each rank all places of its signature by a permutation of
their own; a place keeps the smallest rank that any element gives it, plus a fraction.
The ranks of one element are all different, which correlates the places and lowers the
variance of the estimate, and a text is done as soon as every place holds a smaller
value than the next rank could give. Texts are handled together, one rank at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.graph import components
from tickloom.llm.ragged import U64, Hasher, flat, groups, mix, pieces, words
from tickloom.llm.store import removed, written

SHINGLE_WORDS = 5
#: A prime: ``(start + rank * step) mod PLACES`` then visits every place once.
PLACES = 83
BAND_ROWS = 4
#: 20 bands of 4 places: a pair at similarity 0.85 shares none with probability 4e-7.
BANDS = PLACES // BAND_ROWS
#: How many members of a bucket, on average, are compared with all others.
HUBS = 2.0
#: What tells texts apart in joins: the smallest id that has one, which may have others too.
TEXT = ["rep", "digest_a"]
#: Blocks of a bucket have about so many members, and so many shingles, at most.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 1 << 18
#: Cells of the bit tables of a pair of blocks.
BITMAP_CELLS = 1 << 23


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, flat, and their offsets."""
    starts, ends, rows = words(data, offsets)
    hashes = hasher(data, starts, ends)
    n_rows = len(offsets) - 1
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))
    sets, sizes = [], np.zeros(n_rows + 1, np.int64)
    combined = np.zeros(len(hashes), U64)
    for k in range(SHINGLE_WORDS):
        combined[: len(hashes) - k] += mix(hashes[k:] + U64(k))
    combined = mix(combined + U64(SHINGLE_WORDS))
    for row in np.flatnonzero(counts):
        lo, hi = first[row], first[row + 1]
        if hi - lo < SHINGLE_WORDS:
            whole = mix(hashes[lo:hi] + np.arange(hi - lo, dtype=U64)).sum(dtype=U64)
            found = mix(np.array([whole + U64(hi - lo)], U64))
        else:
            found = np.sort(combined[lo : hi - SHINGLE_WORDS + 1])
            fresh = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=fresh[1:])
            found = found[fresh]
        sets.append(found)
        sizes[row + 1] = len(found)
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.cumsum(sizes)


def signatures(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The signature of each row's set; rows without elements keep the largest value."""
    n_rows = len(offsets) - 1
    places = np.full(n_rows * PLACES, np.iinfo(U64).max, U64)
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    start = (elements % U64(PLACES)).astype(np.int64)
    step = 1 + ((elements >> U64(32)) % U64(PLACES - 1)).astype(np.int64)
    for rank in range(PLACES):
        at = row * PLACES + (start + rank * step) % PLACES
        fraction = mix(elements + U64(rank + 1)) >> U64(32)
        np.minimum.at(places, at, U64(rank << 32) + fraction)
        open_rows = places.reshape(n_rows, PLACES).max(axis=1) >= U64((rank + 1) << 32)
        live = open_rows[row]
        if not live.any():
            break
        if not live.all():
            elements, row, start, step = elements[live], row[live], start[live], step[live]
    return places.reshape(n_rows, PLACES)


def band_keys(places: np.ndarray) -> np.ndarray:
    """One hash per band, of the band's number and its places."""
    used = mix(places[:, : BANDS * BAND_ROWS].reshape(len(places), BANDS, BAND_ROWS) + U64(1))
    weights = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=U64)).reshape(BANDS, BAND_ROWS)
    return mix((used * (weights | U64(1))).sum(axis=2, dtype=U64) + np.arange(BANDS, dtype=U64))


def _longs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _digest(elements: np.ndarray, offsets: np.ndarray, salt: int) -> pa.Array:
    """A number of each row's set, the same in whatever order its elements come."""
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(elements + U64(salt)), dtype=U64)))
    return pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in pieces(batches, "text"):
        elements, offsets = shingle_sets(*flat(batch.column("text")), hasher)
        sizes = np.diff(offsets)
        digests = [_digest(elements, offsets, salt) for salt in (1, 2)]
        keys = band_keys(signatures(elements, offsets))
        held = np.where(sizes > 0, BANDS, 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes),
                *digests,
                _longs(keys[sizes > 0].ravel(), np.concatenate(([0], np.cumsum(held)))),
            ],
            names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in pieces(batches, "text"):
        elements, offsets = shingle_sets(*flat(batch.column("text")), hasher)
        digest = _digest(elements, offsets, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), digest, _longs(elements, offsets)], names=["rep", "digest_a", "elements"]
        )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): those of ``pairs`` whose full sets are similar enough."""
    hubs = sets.select(*(F.col(name).alias(f"hub_{name}") for name in (*TEXT, "elements")))
    shared = F.size(F.array_intersect("hub_elements", "elements"))
    sizes = F.size("hub_elements") + F.size("elements")
    met = pairs.join(hubs, [f"hub_{name}" for name in TEXT]).join(sets, TEXT)
    alike = met.where(100 * shared >= percent * (sizes - shared))
    return alike.select(F.least("hub_rep", "rep").alias("a"), F.greatest("hub_rep", "rep").alias("b"))


def _may_link(elements: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets can be similar enough, by an exact bound.

    Every set marks its elements in a bit table. Each bit that only one of two sets
    marks is an element the other lacks, so the count of such bits bounds what they
    share from above; no similar pair is missed.
    """
    sizes = np.diff(offsets)
    n = len(sizes)
    width = 1 << int(np.clip(np.log2(BITMAP_CELLS / n), 10, 16))
    marks = np.zeros((n, width), np.float32)
    marks[np.repeat(np.arange(n), sizes), (elements >> U64(40)).astype(np.int64) & (width - 1)] = 1
    own = marks.sum(axis=1)
    lacking = own[:, None] - marks @ marks.T
    most = np.minimum(sizes[:, None] - lacking, (sizes[:, None] - lacking).T)
    return 100 * most >= percent * (sizes[:, None] + sizes[None, :] - most)


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(one, other)
    shared = int((one[np.minimum(at, len(one) - 1)] == other).sum())
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def _joining(percent: int):
    """Links between different groups of the members of a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for group in groups(batches, ["band", "low", "high"]):
            if group.num_rows < 2:
                continue
            reps, label = group.column("rep").to_numpy(), group.column("component").to_numpy().copy()
            held = group.column("elements").combine_chunks()
            sizes = held.value_lengths().to_numpy()
            offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            elements = held.flatten().to_numpy().view(U64)
            sets = [elements[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:])]
            open_pairs = _may_link(elements, offsets, percent)
            for i in range(len(reps)):
                while len(others := np.flatnonzero(open_pairs[i] & (label != label[i]))):
                    for j in others:
                        open_pairs[i, j] = open_pairs[j, i] = False
                        if _similar(sets[i], sets[j], percent):
                            left.append(reps[i])
                            right.append(reps[j])
                            label[label == label[j]] = label[i]
                            break
            if len(left) > 4096:
                yield pa.RecordBatch.from_pydict({"a": left, "b": right})
                left, right = [], []
        if left:
            yield pa.RecordBatch.from_pydict({"a": left, "b": right})

    return run


def _first_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of the first members of every bucket with those after them."""
    first = members.where(F.col("turn") < HUBS).select(
        "band",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *(F.col(c).alias(f"hub_{c}") for c in (*TEXT, "turn", "n_shingles")),
    )
    return (
        members.join(first, ["band", "part"])
        .where("turn > hub_turn or turn = hub_turn and rep > hub_rep")
        .where(f"least(n_shingles, hub_n_shingles) * 100 >= greatest(n_shingles, hub_n_shingles) * {percent}")
        .select(*(f"hub_{name}" for name in TEXT), *TEXT)
        .distinct()
    )


def _other_links(spark: SparkSession, members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between groups that the later members of the buckets still show."""
    joined = components(spark, found).select(F.col("id").alias("rep"), "component")
    rest = members.where(F.col("turn") >= HUBS).join(joined, "rep", "left")
    rest = written(spark, rest.withColumn("component", F.coalesce("component", "rep")), "rest")
    # The largest group of a bucket needs no comparing with itself, only with the others:
    # of its blocks, numbered first, no two make a pair.
    by_group = rest.groupBy("band", "component").agg(
        F.count("*").alias("n"), F.max("parts").alias("parts"), F.sum("n_shingles").alias("weight")
    )
    size = F.struct("n", "component")
    by_band = by_group.groupBy("band").agg(
        F.max("parts").alias("parts"),
        F.sum("n").alias("n"),
        F.sum("weight").alias("weight"),
        F.max("n").alias("main_n"),
        F.max_by("weight", size).alias("main_weight"),
        F.max_by("component", size).alias("main"),
    )

    def blocks(n: str, weight: str) -> Column:
        return F.ceil(F.greatest(F.expr(n) / BLOCK_MEMBERS, F.expr(weight) / BLOCK_SHINGLES)).cast("int")

    by_band = by_band.where("n > main_n").select(
        "band",
        "main",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        blocks("main_n", "main_weight").alias("main_blocks"),
        blocks("n - main_n", "weight - main_weight").alias("other_blocks"),
    )
    in_main, last = F.col("component") == F.col("main"), F.col("main_blocks") + F.col("other_blocks") - 1
    turned = F.xxhash64("rep", F.lit(5))
    block = F.when(in_main, F.pmod(turned, F.col("main_blocks"))).otherwise(
        F.col("main_blocks") + F.pmod(turned, F.col("other_blocks"))
    )
    placed = (
        rest.join(by_band, ["band", "part"])
        .withColumn("block", block.cast("int"))
        .select("*", F.explode(F.sequence(F.when(in_main, F.col("main_blocks")).otherwise(0), last)).alias("other"))
        .select("band", *TEXT, "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .join(sets, TEXT)
        .repartition("band", "low", "high")
        .sortWithinPartitions("band", "low", "high")
    )
    return placed.mapInArrow(_joining(percent), "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """Groups of near-duplicate texts of ``docs (doc_id, text, ...)``.

    Returns doc_id, n_shingles, component_id and kept for every row. Two texts are
    linked if their sets of word 5-shingles have at least ``percent`` hundredths of
    their union in common; a group is what links reach.

    Texts with equal sets form a class, and its smallest doc_id stands for it. The
    members of a band's bucket have a random order. Its first ones are compared with all
    others, which already brings true groups together. Buckets whose other members are
    still in different groups are then cut into blocks, and every pair of blocks is a
    small group of rows whose members are compared where they meet; what comes out are
    the links that join groups, not pairs. So no bucket is brought together in one task,
    and every pair that shares a bucket is linked, refused, or within one group.

    Null, empty and blank texts have no shingles and are groups of their own; texts of
    any length are compared whole, very long ones one at a time. Rows with the same doc_id
    and the same text count as one text in two rows. Several texts under one doc_id are
    all compared, and as links are between ids, what any of them is linked with is one
    group. A row without doc_id joins no group: its component_id is null and it is not
    kept. An empty table gives an empty one. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(
        spark,
        docs.mapInArrow(_sketch, "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>"),
        "sketches",
    )
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("digest_a", "digest_b").agg(F.min("doc_id").alias("rep"))
    classes = written(spark, classes, "classes")
    reps = full.join(
        classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest_a", "digest_b"], "left_semi"
    )
    banded = reps.select(F.col("doc_id").alias("rep"), "digest_a", "n_shingles", F.explode("bands").alias("band"))
    banded = banded.distinct()
    crowded = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    turn = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30)) / float(1 << 30) * F.col("n")
    # Joins by band go by part of the bucket as well, so that no task has a whole large one.
    parts = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    part = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("parts")).cast("int")
    members = banded.join(crowded, "band").withColumns({"turn": turn, "parts": parts}).withColumn("part", part)
    members = written(spark, members.drop("n"), "members")
    needed = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = written(
        spark,
        docs.join(needed, "doc_id", "left_semi")
        .mapInArrow(_sets, "rep long, digest_a long, elements array<long>")
        .dropDuplicates(TEXT),
        "sets",
    )

    found = written(spark, _confirmed(_first_pairs(members, percent), sets, percent), "found")
    links = found.unionByName(written(spark, _other_links(spark, members, found, sets, percent), "found"))
    groups_found = components(spark, links).select(F.col("id").alias("rep"), "component")

    labelled = classes.join(groups_found, "rep", "left").select(
        "digest_a", "digest_b", F.coalesce("component", "rep").alias("component_id")
    )
    with_groups = (
        sketches.select("doc_id", "n_shingles", "digest_a", "digest_b")
        .join(labelled, ["digest_a", "digest_b"], "left")
        .withColumn(
            "component_id",
            F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))),
        )
    )
    removed(spark, members, sets)
    return with_groups.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
