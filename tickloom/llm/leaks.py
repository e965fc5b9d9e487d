"""Benchmark decontamination by latent semantic retrieval and sequence checks.

Texts are cut into short segments; those make up a matrix of TF-IDF weights over the
benchmark's vocabulary. A randomised singular value decomposition, gathered in one pass
over all texts, gives a latent space in which windows of consecutive segments are
searched for each benchmark passage by cosine. Windows that may hold enough of a
passage's words, by a bound that misses none, are candidates whatever their cosine.
Candidates are confirmed by the longest common subsequence of words; one that only
paraphrases must also hold the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import U64, Hasher, flat, mix, pieces, runs
from tickloom.llm.store import written

#: Words of a segment; windows start at every segment.
SEGMENT = 8
#: Benchmark texts are searched for in passages of at most this many words (bits of a
#: machine word, one per word of the passage).
PASSAGE = 64
#: Texts of fewer words are no passages: they are probed for word by word.
LEAST_WORDS = 5
#: Bytes of benchmark text searched for at once; a larger benchmark takes more rounds
#: over the texts' word numbers, never over the texts.
BLOCK_BYTES = 1 << 18
#: Tasks whose sums are added up together before the rest.
SUMMED = 512
#: Dimensions of the random range finder, and of the latent space kept of it.
SKETCH, LATENT = 64, 56
#: Weights are as if every word had been met in so many further segments without it.
PRIOR_SEGMENTS = 10_000
#: From words in one of so many segments on, weights fall towards 0 but never reach it.
COMMON = 20
LEAST_COSINE = 0.45
#: A window needs this share of a passage's squared weight to be searched at all.
LEAST_WEIGHT = 0.4
#: Shares of a passage's words found in order: a copy, and a paraphrase with the answer.
COPY, PARAPHRASE = 0.8, 0.6
#: Without an answer of its own, a passage's last words count as one.
ANSWER_WORDS = 5
#: Words fall into so many buckets for the bound on what a window holds of a passage.
BUCKETS = 128

#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[128:] = INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = True


def _hashed(items: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some items, and the item of each."""
    data, offsets = flat(pc.utf8_lower(pa.array([t for _, t in items], pa.string())))
    starts, ends, rows = runs(INSIDE[data], offsets)
    return Hasher()(data, starts, ends), rows


class Numbers:
    """Where 64-bit hashes are in a sorted array of them, by a table of their first bits."""

    def __init__(self, vocabulary: np.ndarray):
        bits = min(20, max(1, 3 + int(len(vocabulary)).bit_length()))
        self.vocabulary, self.shift = vocabulary, U64(64 - bits)
        start = np.searchsorted(vocabulary >> self.shift, np.arange((1 << bits) + 1, dtype=U64))
        self.start, self.steps = start[:-1], int(np.diff(start).max(initial=0))

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are there, and the places of those."""
        at = self.start[(hashes >> self.shift).astype(np.int64)]
        last = len(self.vocabulary) - 1
        known, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.arange(len(hashes))
        for _ in range(self.steps):
            at = np.minimum(at, last)
            there = self.vocabulary[at]
            same = there == hashes
            known.append(left[same])
            place.append(at[same])
            more = there < hashes
            left, hashes, at = left[more], hashes[more], at[more] + 1
        known, place = np.concatenate(known), np.concatenate(place)
        order = np.argsort(known, kind="stable")
        return known[order], place[order]


class Passages:
    """A block of the benchmark: passages as numbers of ``vocabulary``, their answers."""

    def __init__(self, items: list[tuple[int, str]], vocabulary: np.ndarray):
        hashes, rows = _hashed(items)
        self.vocabulary = vocabulary
        numbers = np.searchsorted(vocabulary, hashes)
        cuts = np.searchsorted(rows, np.arange(len(items) + 1))
        self.items, self.words = [], []
        #: By their number of words, the short items: word numbers, and item ids.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        short: dict[int, list] = {}
        for row, (item, _) in enumerate(items):
            mine = numbers[cuts[row] : cuts[row + 1]]
            if 0 < len(mine) < LEAST_WORDS:
                short.setdefault(len(mine), []).append((mine, item))
            n_parts = max(1, -(-len(mine) // PASSAGE))
            for part in np.array_split(mine, n_parts):
                if len(part) >= LEAST_WORDS:
                    self.items.append(item)
                    self.words.append(part.astype(np.int64))
        for n, found in short.items():
            self.short[n] = np.stack([w for w, _ in found]), np.array([i for _, i in found], np.int64)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.windows = -(-self.lengths // SEGMENT) + 1
        # How many words of each passage, and of its answer, are in each bucket.
        self.buckets = (mix(self.vocabulary) >> U64(32)).astype(np.int64) % BUCKETS
        self.spread, self.answers = (
            np.array([np.bincount(self.buckets[w[-n:]], minlength=BUCKETS) for w in self.words], np.float32)
            for n in (PASSAGE, ANSWER_WORDS)
        )
        # For each passage and word, the bits of the word's places in the passage.
        n_words = max(1, len(self.vocabulary))
        keys = [i * n_words + w for i, w in enumerate(self.words)]
        bits = [U64(1) << np.arange(len(w), dtype=U64) for w in self.words]
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.mask_keys, first = np.unique(keys[order], return_index=True)
        bits = np.concatenate(bits)[order] if len(keys) else np.zeros(0, U64)
        self.masks = np.bitwise_or.reduceat(bits, first) if len(keys) else bits

    def held(self, marks: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows, by the buckets they mark, and passages of ``mine`` that may be leaked.

        A word in a window marks its bucket, so the words of a passage in marked buckets
        bound from above what the window holds of it.
        """
        most = marks @ self.spread[mine].T
        lengths = self.lengths[mine]
        hit, which = np.nonzero(most >= np.ceil(PARAPHRASE * lengths - 1e-6).astype(np.float32))
        most, which = most[hit, which], mine[which]
        answer = (marks[hit] * self.answers[which]).sum(axis=1)
        may = (most >= COPY * self.lengths[which] - 1e-6) | (answer >= ANSWER_WORDS - 1)
        return hit[may], which[may]

    def common(self, passage: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Which words of each passage are in a longest common subsequence, as bits.

        ``words`` has one row of word numbers per passage, filled up with -1. A cleared
        bit of the bit-parallel recurrence is a matched word.
        """
        state = np.full(len(passage), ~U64(0))
        n_words = max(1, len(self.vocabulary))
        for column in words.T:
            key = passage * n_words + column
            at = np.minimum(np.searchsorted(self.mask_keys, key), len(self.mask_keys) - 1)
            mask = np.where((column >= 0) & (self.mask_keys[at] == key), self.masks[at], U64(0))
            both = state & mask
            state = (state + both) | (state - both)
        return ~state


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, always the same ones together."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.where("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _sequences(passages: Passages, words: np.ndarray, places: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows and short items whose words stand in them one right after the other."""
    for n, (sequences, items) in passages.short.items():
        at = np.arange(len(words) - n + 1)
        for k in range(1, n):
            at = at[(rows[at + k] == rows[at]) & (places[at + k] == places[at] + k)]
        # By a first hash, then word by word.
        key, mine = mix(words[at].astype(U64)), mix(sequences[:, 0].astype(U64))
        for k in range(1, n):
            key = mix(key + words[at + k].astype(U64))
            mine = mix(mine + sequences[:, k].astype(U64))
        order = np.argsort(mine, kind="stable")
        low, high = (np.searchsorted(mine[order], key, side) for side in ("left", "right"))
        counts = high - low
        which = order[np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
        where = np.repeat(at, counts)
        same = (words[where[:, None] + np.arange(n)] == sequences[which]).all(axis=1)
        yield from set(zip(rows[where[same]].tolist(), items[which[same]].tolist()))


def _features(shared):
    """Per text the numbers and places of its vocabulary words; per task their spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, hasher = shared.value, Hasher()
        numbers = Numbers(vocabulary)
        task, n = TaskContext.get().partitionId() << 40, 0
        spread, n_segments = np.zeros(len(vocabulary), np.int64), 0
        for batch in pieces(batches, "text"):
            data, offsets = flat(pc.utf8_lower(batch.column("text")))
            starts, ends, rows = runs(INSIDE[data], offsets)
            counts = np.bincount(rows, minlength=batch.num_rows)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            hashes = hasher(data, starts, ends)
            known, at = numbers(hashes)
            place, rows = place[known], rows[known]
            segments = -(-counts // SEGMENT)
            segment = (np.cumsum(segments) - segments)[rows] + place // SEGMENT
            met = np.sort(segment * len(vocabulary) + at)
            met = met[np.diff(met, prepend=-1) > 0]
            spread += np.bincount(met % len(vocabulary), minlength=len(vocabulary))
            n_segments += int(segments.sum())
            ends_at = pa.array(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=batch.num_rows)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(task + n + np.arange(batch.num_rows)),
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(ends_at, pa.array(at.astype(np.int32))),
                    pa.ListArray.from_arrays(ends_at, pa.array(place.astype(np.int32))),
                    pa.nulls(batch.num_rows, pa.int64()),
                ],
                names=["row_id", "doc_id", "words", "places", "n_segments"],
            )
            n += batch.num_rows
        if n:
            met = np.flatnonzero(spread)
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": pa.array([-1], pa.int64()),
                    "doc_id": pa.array([None], pa.int64()),
                    "words": pa.array([met.tolist()], pa.list_(pa.int32())),
                    "places": pa.array([spread[met].tolist()], pa.list_(pa.int32())),
                    "n_segments": pa.array([n_segments], pa.int64()),
                }
            )

    return run


def _lists(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row ids, words, places and rows of pieces of at most ``limit`` words, or one row."""
    for batch in batches:
        totals = np.cumsum(batch.column("words").value_lengths().to_numpy(), dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            before = totals[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(totals, before + limit, side="right")))
            part = batch.slice(lo, hi - lo)
            lengths = part.column("words").value_lengths().to_numpy()
            rows = np.repeat(np.arange(part.num_rows), lengths)
            words = part.column("words").flatten().to_numpy().astype(np.int64)
            places = part.column("places").flatten().to_numpy().astype(np.int64)
            yield part.column("row_id").to_numpy(), words, places, rows
            lo = hi


def _segment_sums(table: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` named by each segment's words, few per segment."""
    sizes = np.diff(np.append(first, len(words)))
    sums = table[words[first]]
    for k in range(1, int(sizes.max(initial=1))):
        longer = np.flatnonzero(sizes > k)
        sums[longer] += table[words[first[longer] + k]]
    return sums


def _sketched(shared):
    """The task's share of the Gram matrix of all segments times a random matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, test = shared.value
        weighted = test * weight[:, None]
        total = np.zeros(test.shape[::-1], np.float64)
        for _, words, places, rows in _lists(batches, 40_000):
            if not len(words):
                continue
            segment = rows << 40 | places // SEGMENT
            first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            seen = np.ascontiguousarray(_segment_sums(weighted, words, first).T)
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
            for sums, values in zip(total, seen):
                sums += np.bincount(words, values[of], len(weight))
        total = total.T * weight[:, None]
        for lo in range(0, len(total), 1024):
            part = total[lo : lo + 1024]
            if part.any():
                yield pa.RecordBatch.from_pydict({"part": [lo // 1024], "sums": [part.astype(np.float32).tobytes()]})

    return run


def _added(key: tuple, shares: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s.as_buffer(), np.float32).astype(np.float64) for s in shares.column("sums"))
    return pa.Table.from_pydict({"part": [key[0].as_py()], "sums": [total.astype(np.float32).tobytes()]})


def latent_space(gram: np.ndarray, test: np.ndarray) -> np.ndarray:
    """Whitened word vectors from ``gram = C @ test``, C the Gram matrix of all segments.

    The leading eigenvectors of C, which are the right singular vectors of the segment
    matrix, come from its Nystrom approximation; every direction counts the same.
    """
    core = test.T @ gram
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > 1e-9 * max(values.max(initial=0), 1e-30)
    factor = gram @ (vectors[:, kept] / np.sqrt(values[kept]))
    left, singular, _ = np.linalg.svd(factor, full_matrices=False)
    kept = singular[:LATENT] > 1e-6 * max(singular.max(initial=0), 1e-30)
    return (left[:, :LATENT][:, kept] / singular[:LATENT][kept]).astype(np.float32)


def _further(slot: np.ndarray, start: np.ndarray, last: np.ndarray, k: int, beyond: int) -> np.ndarray:
    """The slots of the segments ``k`` after the starts, ``beyond`` where the window ends before."""
    at = start + k
    return np.where(at < last, slot[np.minimum(at, len(slot) - 1)], beyond)


def _found(shared, own_passages):
    """What texts hold: row_id, item_id and the share of words in order; null for short items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weight, space), passages = shared.value, own_passages.value
        weighted = space * weight[:, None]
        vectors = np.zeros((len(passages.words), space.shape[1]), np.float32)
        for k, w in enumerate(passages.words):
            vectors[k] = weighted[w].sum(axis=0)
        norms = np.sqrt((vectors**2).sum(axis=1))
        masses = np.array([(weight[w] ** 2).sum() for w in passages.words])
        # The sizes of windows, each with the words of the passages searched for in such.
        sizes = []
        for size in np.unique(passages.windows):
            own = np.zeros(len(weight), bool)
            own[np.concatenate([w for w, k in zip(passages.words, passages.windows) if k == size])] = True
            sizes.append((size, own))
        for row_ids, words, places, rows in _lists(batches, 60_000):
            if not len(words):
                continue
            best: dict[tuple[int, int], float | None] = {}
            for row, item in _sequences(passages, words, places, rows):
                best[int(row_ids[row]), item] = None
            n_segments = np.zeros(len(row_ids), np.int64)
            np.maximum.at(n_segments, rows, places // SEGMENT + 1)
            first = np.concatenate(([0], np.cumsum(n_segments)))
            segment = first[rows] + places // SEGMENT
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            mass = np.concatenate(([0.0], np.cumsum(np.bincount(segment, weight[words].astype(float) ** 2, first[-1]))))
            row_of = np.repeat(np.arange(len(row_ids)), n_segments)
            at = np.arange(first[-1])
            low, high = first[row_of], first[row_of + 1]
            spans, bounded, used = {}, {}, np.zeros(first[-1] + 1, np.int64)
            for size, own in sizes:
                mine = passages.windows == size
                last = np.minimum(at + size, high)
                whole = (at + size == last) | (at == low)
                # No window is confirmed without so many words of this size's passages
                # in it and the segments beside it.
                least_words = PARAPHRASE * passages.lengths[mine].min() - 1e-6
                held = np.concatenate(([0], np.cumsum(np.bincount(segment[own[words]], minlength=first[-1]))))
                wide = held[np.minimum(last + 1, high)] - held[np.maximum(at - 1, low)] >= least_words
                least = LEAST_WEIGHT * masses[mine].min()
                start = at[whole & wide & (mass[last] - mass[:-1] >= least)]
                spans[size] = start, last[start]
                near = at[whole & (held[last] - held[:-1] >= least_words)]
                bounded[size] = near, last[near]
                for some in (start, near):
                    np.add.at(used, some, 1)
                    np.add.at(used, last[some], -1)
            # Only the segments of windows that are searched for need their vectors.
            needed = np.cumsum(used)[:-1] > 0
            slot = np.cumsum(needed) - 1
            # The last row stands for what lies beyond a window.
            n_needed = int(needed.sum())
            vector = np.zeros((n_needed + 1, space.shape[1]), np.float32)
            marked = np.zeros((n_needed + 1, BUCKETS), bool)
            mine = needed[segment]
            if mine.any():
                kept_segments, kept_words = segment[mine], words[mine]
                marked[slot[kept_segments], passages.buckets[kept_words]] = 1
                starts = np.flatnonzero(np.concatenate(([True], kept_segments[1:] != kept_segments[:-1])))
                vector[slot[kept_segments[starts]]] = _segment_sums(weighted, kept_words, starts)
            marked = np.packbits(marked, axis=1).view(np.uint64)
            pairs = []
            for size, _ in sizes:
                mine = np.flatnonzero(passages.windows == size)
                for lo in range(0, len(bounded[size][0]), 4096):
                    start, last = (x[lo : lo + 4096] for x in bounded[size])
                    marks = marked[slot[start]]
                    for k in range(1, int(size)):
                        marks |= marked[_further(slot, start, last, k, n_needed)]
                    marks = np.unpackbits(marks.view(np.uint8), axis=1).astype(np.float32)
                    hit, which = passages.held(marks, mine)
                    pairs.append(np.stack((start[hit], last[hit], which)))
            for size, _ in sizes:
                start, last = spans[size]
                mine = np.flatnonzero((passages.windows == size) & (norms > 0))
                if not len(start) or not len(mine):
                    continue
                window = vector[slot[start]]
                for k in range(1, int(size)):
                    window += vector[_further(slot, start, last, k, n_needed)]
                length = np.sqrt((window**2).sum(axis=1))
                least = LEAST_COSINE * norms[mine] * np.maximum(length[:, None], norms[mine])
                hit, which = np.nonzero(window @ vectors[mine].T >= least)
                enough = mass[last[hit]] - mass[start[hit]] >= LEAST_WEIGHT * masses[mine[which]]
                hit, which = hit[enough], which[enough]
                pairs.append(np.stack((start[hit], last[hit], mine[which])))
            pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((3, 0), np.int64)
            if pairs.shape[1]:
                pairs = np.unique(pairs, axis=1)
            for lo in range(0, pairs.shape[1], 8192):
                start, last, passage = pairs[:, lo : lo + 8192]
                row = row_of[start]
                # One more segment on either side, within the text.
                low = np.searchsorted(segment, np.maximum(start - 1, first[row]))
                high = np.searchsorted(segment, np.minimum(last + 1, first[row + 1]))
                width = int((high - low).max())
                at_word = low[:, None] + np.arange(width)
                in_window = np.where(at_word < high[:, None], words[np.minimum(at_word, len(words) - 1)], -1)
                matched = passages.common(passage, in_window)
                lengths = passages.lengths[passage]
                inside = matched & (~U64(0) >> (U64(64) - lengths.astype(U64)))
                share = np.bitwise_count(inside) / lengths
                answer = np.bitwise_count(inside >> (lengths - np.minimum(lengths, ANSWER_WORDS)).astype(U64))
                leaked = (share >= COPY) | ((share >= PARAPHRASE) & (answer >= ANSWER_WORDS - 1))
                for r, p, s in zip(row[leaked], passage[leaked], share[leaked]):
                    key = (int(row_ids[r]), passages.items[p])
                    best[key] = max(best.get(key) or 0.0, float(s))
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in best], pa.int64()),
                        pa.array([k[1] for k in best], pa.int64()),
                        pa.array(list(best.values()), pa.float64()),
                    ],
                    names=["row_id", "item_id", "overlap"],
                )

    return run


def word_weights(n_segments: int, spread: np.ndarray) -> np.ndarray:
    """Weights of words found in ``spread`` of ``n_segments``, each above 0.

    Rare words weigh about the logarithm of how much rarer than 1 in ``COMMON`` they are.
    """
    return np.log1p((n_segments + PRIOR_SEGMENTS) / (spread + 1) / COMMON).astype(np.float32)


def _numbered(spark: SparkSession, docs: DataFrame, vocabulary: np.ndarray) -> tuple[DataFrame, DataFrame, tuple]:
    """The rows of ``docs``, the words of those that have any, their weights and latent space.

    Texts are read once, whatever the size of the benchmark: row numbers, words and
    weights are those of the written table, for every block that is searched for.
    """
    n_words = len(vocabulary)
    features = written(
        spark,
        docs.mapInArrow(
            _features(spark.sparkContext.broadcast(vocabulary)),
            "row_id long, doc_id long, words array<int>, places array<int>, n_segments long",
        ),
        "features",
    )
    tasks = features.where("row_id < 0")
    n_segments = tasks.agg(F.coalesce(F.sum("n_segments"), F.lit(0))).first()[0]
    per_word = tasks.select(F.explode(F.arrays_zip("words", "places")).alias("p")).groupBy("p.words").agg(F.sum("p.places").alias("n"))
    spread = np.zeros(n_words)
    for row in per_word.toLocalIterator():
        spread[row["words"]] = row["n"]
    weight = word_weights(n_segments, spread)

    rows = features.where("row_id >= 0")
    listed = rows.where("size(words) > 0").select("row_id", "words", "places")
    test = np.random.default_rng(11).normal(size=(n_words, min(SKETCH, n_words))).astype(np.float32)
    shares = listed.select("words", "places", "row_id").mapInArrow(
        _sketched(spark.sparkContext.broadcast((weight, test))), "part long, sums binary"
    )
    # In two steps, so that no group is as large as there are tasks.
    shares = shares.withColumn("some", F.floor(F.spark_partition_id() / SUMMED))
    sums = shares.groupBy("part", "some").applyInArrow(_added, "part long, sums binary")
    gram = np.zeros(test.shape)
    for row in sums.groupBy("part").applyInArrow(_added, "part long, sums binary").toLocalIterator():
        added = np.frombuffer(row["sums"], np.float32).reshape(-1, test.shape[1])
        gram[row["part"] * 1024 : row["part"] * 1024 + len(added)] = added
    return rows.select("row_id", "doc_id"), listed, (weight, latent_space(gram, test.astype(float)))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_ids and overlap of every row of ``docs (doc_id, text)``.

    ``item_ids`` lists, in order, the items of ``benchmark (item_id, text)`` a text
    holds: at least ``COPY`` of a passage's words in order within a window of about its
    length, or ``PARAPHRASE`` of them and all but one of the answer, the passage's last
    ``ANSWER_WORDS`` words. ``overlap`` is the largest such share, 0 without any.
    Matching ignores case, punctuation and spacing.

    The benchmark is searched for in blocks of ``BLOCK_BYTES``; its vocabulary, eight bytes
    and a latent vector a word, is what the driver and tasks hold of all of it. All words
    of all texts enter the weights and the decomposition, which do not depend on blocks.
    A text is cut into segments as it is and searched whole, however long.

    Items of fewer than ``LEAST_WORDS`` words are found where all their words stand one
    right after the other, and listed as ``short_items``: a single common word is no
    evidence of a leak, so they do not make a text contaminated.

    Null, empty and blank texts hold nothing, and neither do items that are null, lack
    an id, or have no word. Items of common words only, or with copies in many texts, are
    searched for like all others. An item in several rows is listed once. Each row gives
    a row, also if rows are equal or have no id; an empty table gives an empty one, an
    empty benchmark finds nothing. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    none = F.array().cast("array<long>")
    vocabulary = np.zeros(0, U64)
    for items in _blocks(benchmark):
        vocabulary = np.union1d(vocabulary, _hashed(items)[0])
    if not len(vocabulary):
        nothing = docs.select("doc_id", F.lit(False).alias("contaminated"), none.alias("item_ids"), F.lit(0.0).alias("overlap"))
        return nothing.withColumn("short_items", none)
    rows, listed, space = _numbered(spark, docs, vocabulary)
    shared, found = spark.sparkContext.broadcast(space), None
    for items in _blocks(benchmark):
        passages = spark.sparkContext.broadcast(Passages(items, vocabulary))
        held = listed.mapInArrow(_found(shared, passages), "row_id long, item_id long, overlap double")
        held = written(spark, held, "leaks")
        passages.destroy()
        found = held if found is None else found.unionByName(held)
    leaked = F.col("overlap").isNotNull()
    held = found.groupBy("row_id").agg(
        F.array_sort(F.collect_set(F.when(leaked, F.col("item_id")))).alias("item_ids"),
        F.max("overlap").alias("overlap"),
        F.array_sort(F.collect_set(F.when(~leaked, F.col("item_id")))).alias("short_items"),
    )
    return rows.join(held, "row_id", "left").select(
        "doc_id",
        F.col("overlap").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce("overlap", F.lit(0.0)).alias("overlap"),
        F.coalesce("short_items", none).alias("short_items"),
    )
