"""Hard negatives: exact search over Hilbert-ordered Parquet blocks with zone maps.

Vectors of whole numbers are ordered by label and by their place on a Hilbert curve
through a coarse view of them, and written as blocks: some rows' ids and components,
and of each component the least and the greatest value, the block's zone map. From an
anchor and a zone map, interval arithmetic bounds the scores of all rows of the block.
A grid of cells sets anchors against zone maps, which are read without the vectors, and
names for each anchor the blocks that may hold what it looks for; only these are joined
with it. Anchors look first for their positives, then, in windows of scores that these
open, for negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.store import removed, written

#: Axes of the curve, sums of as many runs of components, and bits of each.
AXES = 8
BITS = 7
#: Components of a block and of the anchors of a chunk, in bytes, and rows of either.
BLOCK_BYTES = 1 << 18
CHUNK_BYTES = 1 << 14
MOST_ROWS = 4096
#: Zone maps and chunks of a cell, on average.
PAGE = 256
BAND = 64
#: Rows that a task gathers before it keeps the best of them only.
GATHERED = 1 << 18

LEAST = np.iinfo(np.int64).min

_FOUND = "chunk long, slot int, place int, anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Numbers along the Hilbert curve of ``places`` (rows by axes, ``bits`` bits each)."""
    axes = [column.astype(np.int64) for column in places.T]
    if not axes:
        return np.zeros(len(places), np.int64)
    for bit in range(bits - 1, 0, -1):  # turn and mirror each cube into its parent's frame
        below = (1 << bit) - 1
        for k in range(len(axes)):
            upper = (axes[k] >> bit & 1) == 1
            swap = np.where(upper, 0, (axes[0] ^ axes[k]) & below)
            axes[0] = np.where(upper, axes[0] ^ below, axes[0]) ^ swap
            if k:
                axes[k] = axes[k] ^ swap
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros(len(places), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    code = np.zeros(len(places), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            code = code << 1 | (axis ^ turn) >> bit & 1
    return code


def most_component(size: int) -> int:
    """The largest component for which the score of ``size`` of them fits a long."""
    return min((1 << 31) - 1, int(np.sqrt(float((1 << 63) - 1) / max(size, 1))) - 1)


def _coarse(matrix: np.ndarray) -> np.ndarray:
    """Cells of a grid that the curve runs through: sums of runs of components, by length."""
    size = matrix.shape[1]
    if not size:
        return np.zeros((len(matrix), 0), np.int64)
    axes = min(AXES, size)
    sums = np.add.reduceat(matrix, np.arange(axes) * size // axes, axis=1)
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    # For random directions a sum is spread by 1 / sqrt(axes); three times that is the edge.
    spread = sums / np.where(norm > 0, norm, 1) * np.sqrt(axes) / 3
    return np.clip(np.floor((spread + 1) / 2 * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.int64)


def _quantised(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                column = pa.chunked_array([part.column("embedding").cast(pa.list_(pa.float64()))]).combine_chunks()
                lengths = column.value_lengths().fill_null(-1).to_numpy()
                values = column.flatten().to_numpy(zero_copy_only=False)
                starts = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))[:-1]))
                rows, codes, texts = [], [], []
                for size in np.unique(lengths[lengths >= 0]).tolist():
                    mine = np.flatnonzero(lengths == size)
                    matrix = values[starts[mine][:, None] + np.arange(size)].reshape(len(mine), size)
                    good = np.isfinite(matrix).all(axis=1)  # a null component reads as not a number
                    mine, matrix = mine[good], matrix[good]
                    most = most_component(size)
                    with np.errstate(over="ignore"):
                        matrix = np.clip(np.floor(scale * matrix), -most, most)
                    rows.append(mine)
                    codes.append(hilbert(_coarse(matrix), BITS))
                    texts += [row.tobytes() for row in matrix.astype("<i4")]
                rows = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
                kept = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("vec_id"),
                        kept.column("label"),
                        pa.array(lengths[rows].astype(np.int32)),
                        pa.array(np.concatenate([*codes, np.zeros(0, np.int64)]).astype(np.int64)),
                        pa.array(texts, pa.binary()),
                    ],
                    names=["vec_id", "label", "size", "code", "vector"],
                )

    return run


def _ints(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(-1, size) if size else np.zeros((0, 0), np.int32)


def _matrix(row: dict, name: str = "vectors") -> np.ndarray:
    """The components of a row's vectors, one vector a line."""
    ids = np.frombuffer(row["ids"], "<i8")
    return np.frombuffer(row[name], "<i4").reshape(len(ids), row["size"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one label and one length as blocks, with their zone maps."""
    task, number = TaskContext.get().partitionId(), 0
    ids, vectors, last = [], [], None

    def block() -> pa.RecordBatch:
        nonlocal number
        number += 1
        matrix = np.frombuffer(b"".join(vectors), "<i4").reshape(len(ids), last[1])
        values = {
            "block": (task << 32) + number,
            "label": last[0],
            "size": last[1],
            "ids": np.array(ids, "<i8").tobytes(),
            "vectors": matrix.tobytes(),
            "lows": matrix.min(axis=0).astype("<i4").tobytes(),
            "highs": matrix.max(axis=0).astype("<i4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([values], _BLOCK)

    for batch in batches:
        for vec_id, label, size, vector in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "size", "vector"))):
            full = len(ids) >= min(MOST_ROWS, max(1, BLOCK_BYTES // max(1, 4 * size)))
            if ids and (full or last != (label, size)):
                yield block()
                ids, vectors = [], []
            last = label, size
            ids.append(vec_id)
            vectors.append(vector)
    if ids:
        yield block()


_BLOCK = pa.schema(
    [("block", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("lows", pa.binary()), ("highs", pa.binary())]
)
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("least", pa.binary())]
)


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: through doubles where these hold them."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = float(np.abs(left.astype(np.int64)).max()) * float(np.abs(right.astype(np.int64)).max()) * left.shape[1]
    if most < 2.0**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every anchor over all vectors between ``lows`` and ``highs``."""
    up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
    lows, highs = lows.T.astype(np.float64), highs.T.astype(np.float64)
    # What rounding may have taken where products are beyond 53 bits, and more.
    slack = 1e-12 * ((up - down) @ np.maximum(np.abs(lows), np.abs(highs)))
    return up @ lows + down @ highs - slack, up @ highs + down @ lows + slack


def _nth(values: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest of each line, or the least number where a line is shorter."""
    if values.shape[1] < n:
        return np.full(len(values), LEAST)
    return np.partition(values, values.shape[1] - n, axis=1)[:, values.shape[1] - n]


def _anchors(every: int, positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The anchors of the blocks, with the score that ``positives`` of their own block reach."""
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def chunk() -> pa.RecordBatch:
            nonlocal number
            number += 1
            parts = [b"".join(x) for x in list(zip(*held))[2:]]
            values = [(task << 32) + number, held[0][0], held[0][1], *parts]
            return pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, values))], _CHUNK)

        for batch in batches:
            for row in batch.to_pylist():
                ids, matrix = np.frombuffer(row["ids"], "<i8"), _matrix(row)
                mine = np.flatnonzero(ids % every == 0)
                for lo in range(0, len(mine), 256):
                    some = mine[lo : lo + 256]
                    found = scores(matrix[some], matrix)
                    found[ids[some][:, None] == ids] = LEAST
                    least = _nth(found, positives)
                    for k, at in enumerate(some.tolist()):
                        full = held and len(held) >= min(MOST_ROWS, max(1, CHUNK_BYTES // max(1, 4 * row["size"])))
                        if held and (full or held[0][:2] != (row["label"], row["size"])):
                            yield chunk()
                            held.clear()
                        held.append((row["label"], row["size"], ids[at].astype("<i8").tobytes(), matrix[at].tobytes(), least[k].astype("<i8").tobytes()))
        if held:
            yield chunk()

    return run


def _windows(row: dict) -> tuple[np.ndarray, ...]:
    """Slots, places, ids and scores of the positives of a chunk's anchors, and their windows' ends."""
    listed = row["windows"] or []
    columns = [np.array([w[name] for w in listed], np.int64) for name in ("slot", "place", "vec_id", "score", "low", "high")]
    return tuple(columns)


def _cells(same: bool):
    def run(chunks: pa.Table, zones: pa.Table) -> pa.Table:
        """Which blocks of a cell each of its chunks must read."""
        blocks, needing = [], []
        if chunks.num_rows and zones.num_rows:
            size = chunks.column("size")[0].as_py()
            names, labels = (zones.column(c).to_numpy() for c in ("block", "label"))
            lows, highs = (_ints(b"".join(zones.column(c).to_pylist()), size).reshape(len(names), size) for c in ("lows", "highs"))
            for row in chunks.to_pylist():
                matrix = _matrix(row)
                fits = (labels == row["label"]) == same
                low, high = bounds(matrix, lows[fits], highs[fits])
                if same:
                    reached = (high >= np.frombuffer(row["least"], "<i8")[:, None]).any(axis=0)
                else:
                    slot, _, _, _, least, most = _windows(row)
                    reached = ((high[slot] >= least[:, None]) & (low[slot] <= most[:, None])).any(axis=0)
                found = names[fits][reached]
                blocks.append(found)
                needing.append(np.full(len(found), row["chunk"], np.int64))
        none = np.zeros(0, np.int64)
        return pa.table({"chunk": np.concatenate([*needing, none]), "block": np.concatenate([*blocks, none])})

    return run


class _Best:
    """The best rows of each (chunk, slot, place): those of a task, reduced as they grow."""

    def __init__(self, most: int):
        self.most, self.held, self.n = most, [], 0

    def add(self, *columns) -> None:
        self.held.append(np.stack(np.broadcast_arrays(*columns)).astype(np.int64))
        self.n += self.held[-1].shape[1]
        if self.n > GATHERED:
            self.held = [self.reduced()]
            self.n = self.held[0].shape[1]

    def reduced(self) -> np.ndarray:
        rows = np.concatenate([*self.held, np.zeros((8, 0), np.int64)], axis=1)
        rows = rows[:, np.lexsort((rows[6], -rows[7], rows[2], rows[1], rows[0]))]
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
        starts = np.flatnonzero(fresh)
        rank = np.arange(rows.shape[1]) - np.repeat(starts, np.diff(np.append(starts, rows.shape[1])))
        return rows[:, rank < self.most]

    def batches(self) -> Iterator[pa.RecordBatch]:
        rows = self.reduced()
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
        names = [field.split()[0] for field in _FOUND.split(", ")]
        for lo in range(0, rows.shape[1], 1 << 16):
            part = rows[:, lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(k) for x, k in zip(part, kinds)], names=names)


def _positives(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(most)
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], "<i8")
                ids = np.frombuffer(row["block_ids"], "<i8")
                found = scores(_matrix(row), np.frombuffer(row["block_vectors"], "<i4").reshape(len(ids), row["size"]))
                other = own[:, None] != ids
                found[~other] = LEAST
                least = np.maximum(_nth(found, most), np.frombuffer(row["least"], "<i8"))
                slot, at = np.nonzero(other & (found >= least[:, None]))
                best.add(row["chunk"], slot, 0, own[slot], 0, 0, ids[at], found[slot, at])
        yield from best.batches()

    return run


def _negatives(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(most)
        for batch in batches:
            for row in batch.to_pylist():
                own, ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["block_ids"], "<i8")
                slot, place, positive, score, low, high = _windows(row)
                found = scores(_matrix(row), np.frombuffer(row["block_vectors"], "<i4").reshape(len(ids), row["size"]))
                step = max(1, GATHERED // max(1, len(ids)))
                for lo in range(0, len(slot), step):
                    mine = slice(lo, lo + step)
                    inside = found[slot[mine]]
                    fits = (inside >= low[mine, None]) & (inside <= high[mine, None])
                    inside = np.where(fits, inside, LEAST)
                    window, at = np.nonzero(fits & (inside >= _nth(inside, most)[:, None]))
                    k = window + lo
                    best.add(row["chunk"], slot[k], place[k], own[slot[k]], positive[k], score[k], ids[at], inside[window, at])
        yield from best.batches()

    return run


def _numbers(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _pairs(chunks: DataFrame, zones: DataFrame, same: bool, pages: int, bands: int) -> DataFrame:
    """(chunk, block): every chunk with the blocks that it must read, cell by cell."""
    keys = ["size", "page", "band"]
    left = chunks.withColumn("band", F.pmod(F.xxhash64("chunk"), F.lit(bands)))
    left = left.withColumn("page", F.explode(_numbers(pages)))
    right = zones.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(pages)))
    right = right.withColumn("band", F.explode(_numbers(bands)))
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(_cells(same), "chunk long, block long")


def _read(pairs: DataFrame, chunks: DataFrame, blocks: DataFrame, finder, most: int) -> DataFrame:
    """What ``finder`` finds where chunks read blocks, the first ``most`` of every place."""
    vectors = blocks.select("block", F.col("ids").alias("block_ids"), F.col("vectors").alias("block_vectors"))
    met = pairs.join(chunks, "chunk").join(vectors, "block")
    found = met.mapInArrow(finder(most), _FOUND)
    first = Window.partitionBy("chunk", "slot", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)


def hard_negatives(
    spark: SparkSession,
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
) -> DataFrame:
    """Hard negatives of the anchors among ``vectors (vec_id, embedding, label)``.

    Components count as ``floor(scale * x)``, in double precision, and the score of two
    rows is their inner product. Anchors are rows whose vec_id is divisible by
    ``every``. An anchor's positives are its first ``positives`` rows of the same label;
    for each, its negatives are the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * score <= high * positive_score``. Higher scores come
    first, ties go to the smaller vec_id. Returns anchor_id, positive_id, rank,
    negative_id, positive_score and negative_score; an anchor without positives or a
    positive without negatives has no rows.

    Rows take no part if vec_id, label or vector is null or a component is null or not
    finite. Rows of zeros and empty vectors do; vectors of different lengths never meet.
    Rows under the anchor's own vec_id are not its positives; apart from that, rows that
    repeat an id, or a whole row, count as rows of their own, and as anchors of their
    own. Components are cut to +-``most_component(length)``, so that scores fit a long
    (for 64 components, some 380 million). Labels are whole numbers. Other columns are
    ignored. Long vectors make smaller blocks, never fewer rows.

    Bounds are safe, so results do not depend on blocks; how many blocks are read does.
    """
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    plain = plain.where("vec_id is not null and label is not null and embedding is not null")
    coded = written(spark, plain.mapInArrow(_quantised(scale), "vec_id long, label long, size int, code long, vector binary"), "coded")
    # Equal vectors share a place on the curve: their ids part them between ranges.
    order = ["label", "size", "code", F.xxhash64("vec_id")]
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = "block long, label long, size int, ids binary, vectors binary, lows binary, highs binary"
    blocks = written(spark, dealt.mapInArrow(_packed, kind), "blocks")
    zones = blocks.select("block", "label", "size", "lows", "highs")
    kind = "chunk long, label long, size int, ids binary, vectors binary, least binary"
    anchors = blocks.select("label", "size", "ids", "vectors")
    chunks = written(spark, anchors.mapInArrow(_anchors(every, positives), kind), "anchors")
    pages, bands = -(-blocks.count() // PAGE) or 1, -(-chunks.count() // BAND) or 1

    pairs = written(spark, _pairs(chunks, zones, True, pages, bands), "same")
    found = written(spark, _read(pairs, chunks, blocks, _positives, positives), "positives")
    # Windows in whole numbers: ``low / 100`` rounded up, ``high / 100`` rounded down.
    score, opened = F.col("score"), []
    for name, share, up in (("low", low, 99), ("high", high, 0)):
        whole, rest = F.expr(f"(score - pmod(score, 100)) div 100 * {share}"), F.expr(f"(pmod(score, 100) * {share} + {up}) div 100")
        opened.append((whole + rest).alias(name))
    opened = found.select("chunk", "slot", F.col("rank").alias("place"), "vec_id", score, *opened).where("low <= high")
    windows = opened.groupBy("chunk").agg(F.collect_list(F.struct("slot", "place", "vec_id", "score", "low", "high")).alias("windows"))
    open_chunks = written(spark, chunks.drop("least").join(windows, "chunk"), "windows")

    wanted = written(spark, _pairs(open_chunks, zones, False, pages, bands), "other")
    result = _read(wanted, open_chunks, blocks, _negatives, negatives)
    removed(spark, coded, found, pairs)
    return result.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND len(a.q) = len(b.q) AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY m.score DESC, m.other_id))::INT AS rank,
       m.other_id AS negative_id, p.positive_score, m.score AS negative_score
FROM positives p JOIN met m ON m.anchor_id = p.anchor_id AND NOT m.same
  AND 50 * p.positive_score <= 100 * m.score AND 100 * m.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY m.score DESC, m.other_id) <= 3
"""
