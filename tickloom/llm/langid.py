"""Language identification by partial matching: one byte context tree per language.

A tree holds, for every context of up to four bytes inside a word, how often each byte
followed. A byte that the longest context has not seen costs an escape and is looked
for under the next shorter one. The statistics are frozen after training, so a text's
code length under each language is the exact sum of those of its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import U64, Hasher, Remembered, flat, gather, mix, pieces, strings, words

#: Longest context in bytes.
ORDER = 4
#: Bytes of training text per language: a bounded, hash-chosen sample of all its texts.
SAMPLE_BYTES = 600_000
#: A text over an eighth of the sample is drawn by pieces of so many bytes.
DRAWN_BYTES = 4096
#: Costs of words, and of windows of bytes, that a task remembers between batches, one
#: for each language; and how many it works out at once.
REMEMBERED, AT_ONCE = 1 << 21, 1 << 22
UNKNOWN = "und"


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a space before and after; positions to code are all but the first."""
    lengths = np.diff(offsets)
    first = offsets[:-1] + 2 * np.arange(len(lengths))
    out = np.full(len(data) + 2 * len(lengths), 32, np.uint8)
    at = np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(len(lengths)), lengths)
    out[at] = data
    return out, np.append(first, len(out))


def _contexts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: the coded positions it applies to, context keys, symbol keys."""
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    wide = data.astype(U64) + U64(1)
    context = np.zeros(len(data), U64)
    for order in range(ORDER + 1):
        if order:
            shifted = np.zeros(len(data), U64)
            shifted[order:] = wide[:-order]
            context = context | (shifted << U64(9 * (order - 1)))
        at = np.flatnonzero(inside >= max(order, 1))
        node = context[at] | U64(order + 1) << U64(56)
        yield at, mix(node), mix((node << U64(8) | node >> U64(56)) ^ mix(wide[at]))


class Sparse:
    """Values by 64-bit key and column, of which few are there; sorted by both."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        """One pair of distinct keys and values for each column."""
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(keys))
        self.n_columns = len(parts)
        self.column = np.repeat(np.arange(self.n_columns, dtype=np.int32), [len(k) for k, _ in parts])[order]
        self.value = np.concatenate([v for _, v in parts])[order]

    def rows(self, keys: np.ndarray, absent: float) -> np.ndarray:
        """The values of all columns for each key, ``absent`` where there is none."""
        out = np.full((len(keys), self.n_columns), absent, np.float32)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        row = np.flatnonzero(self.keys[place] == keys)
        place = place[row]
        sizes = self.first[place + 1] - self.first[place]
        at = np.arange(sizes.sum()) + np.repeat(self.first[place] - np.cumsum(sizes) + sizes, sizes)
        out[np.repeat(row, sizes), self.column[at]] = self.value[at]
        return out


class Trees:
    """Frozen statistics of all languages: per level the bits of escapes and of symbols."""

    def __init__(self, table: Iterable[tuple[str, str, int]]):
        """From language, word and count, in the order of the languages."""
        self.languages = []
        levels = [([], []) for _ in range(ORDER + 1)]
        for lang, rows in groupby(table, lambda row: row[0]):
            self.languages.append(lang)
            found, counts = zip(*((word.encode("utf-8"), n) for _, word, n in rows))
            offsets = np.concatenate(([0], np.cumsum([len(w) for w in found]))).astype(np.int64)
            data, offsets = _padded(np.frombuffer(b"".join(found), np.uint8), offsets)
            weight = np.repeat(counts, np.diff(offsets)).astype(float)
            for level, (at, nodes, symbols) in zip(levels, _contexts(data, offsets)):
                node_keys, node_of = np.unique(nodes, return_inverse=True)
                symbol_keys, first, symbol_of = np.unique(symbols, return_index=True, return_inverse=True)
                seen = np.bincount(symbol_of, weight[at], len(symbol_keys))
                parent = node_of[first]
                totals = np.bincount(parent, seen, len(node_keys))
                kinds = np.bincount(parent, minlength=len(node_keys))
                bits = -np.log2(seen / (totals + kinds)[parent])
                escape = -np.log2(kinds / (totals + kinds))
                level[0].append((node_keys, escape.astype(np.float32)))
                level[1].append((symbol_keys, bits.astype(np.float32)))
        self.levels = [(Sparse(escapes), Sparse(bits)) for escapes, bits in levels if escapes]

    def window_bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The code length of each ragged row's last byte after those before it."""
        n_langs = len(self.languages)
        last = offsets[1:] - 1
        cost = np.zeros((len(last), n_langs), np.float32)
        pending = np.ones((len(last), n_langs), bool)
        levels = [*zip(_contexts(data, offsets), self.levels)]
        for (at, nodes, symbols), (escape, symbol_bits) in reversed(levels):
            row = np.searchsorted(last, at)
            mine = (last[row] == at) & pending[row].any(axis=1)
            row, nodes, symbols = row[mine], nodes[mine], symbols[mine]
            coded = symbol_bits.rows(symbols, np.inf)
            escaped = escape.rows(nodes, 0)
            seen = np.isfinite(coded)
            cost[row] += np.where(pending[row], np.where(seen, coded, escaped), 0)
            pending[row] &= ~seen
        return cost + 8 * pending

    def bits(self, data: np.ndarray, offsets: np.ndarray, remembered: Remembered) -> np.ndarray:
        """The code length of each word under each language.

        A byte's cost depends on itself and at most ``ORDER`` bytes before it, so it is
        worked out once per such window and remembered.
        """
        data, offsets = _padded(data, offsets)
        wide = data.astype(U64) + U64(1)
        inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
        window = wide.copy()
        for back in range(1, ORDER + 1):
            window[back:] |= np.where(inside[back:] >= back, wide[:-back], U64(0)) << U64(9 * back)
        coded_at = np.flatnonzero(inside > 0)
        word_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) - 1)
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        step = max(1, AT_ONCE // max(1, len(self.languages)))
        for lo in range(0, len(coded_at), step):
            at, word = coded_at[lo : lo + step], word_of[lo : lo + step]
            keys, first, which = np.unique(mix(window[at]), return_index=True, return_inverse=True)

            def coded(fresh: np.ndarray) -> np.ndarray:
                end = at[first[fresh]] + 1
                start = end - 1 - np.minimum(inside[end - 1], ORDER)
                return self.window_bits(*gather(data, start, end))

            cost = remembered.get(keys, coded)[which]
            sums = np.concatenate((np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0, dtype=np.float64)))
            edges = np.concatenate(([0], np.flatnonzero(np.diff(word)) + 1, [len(word)]))
            total[word[edges[:-1]]] += sums[edges[1:]] - sums[edges[:-1]]
        return total


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the drawn texts, or of the drawn pieces of a text that is ``cut``."""
    hasher = Hasher()
    for batch in pieces(batches, "text"):
        langs, which = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        data, offsets = flat(batch.column("text"))
        starts, ends, rows = words(data, offsets)
        cut = batch.column("cut").to_numpy(zero_copy_only=False)
        if cut.any():
            # A word goes with the piece that it starts in.
            piece = ((starts - offsets[rows]) // DRAWN_BYTES).astype(U64)
            seed = batch.column("seed").to_numpy().view(U64)
            draw = (mix(mix(seed[rows]) + piece) >> U64(34)) / float(1 << 30)
            drawn = ~cut[rows] | (draw < batch.column("share").to_numpy()[rows])
            starts, ends, rows = starts[drawn], ends[drawn], rows[drawn]
        keys = hasher(data, starts, ends) ^ mix(which[rows].astype(U64) + U64(7))
        _, first, counts = np.unique(keys, return_index=True, return_counts=True)
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs[which[rows[first]]], pa.string()),
                strings(*gather(folded, starts[first], ends[first])),
                pa.array(counts.astype(np.int64)),
            ],
            names=["lang", "word", "n"],
        )


def train(spark: SparkSession, docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Trees:
    """Trees of the languages in ``docs (doc_id, text, lang)``; null ones teach nothing.

    A classifier is fit on a sample, bounded by ``sample_bytes`` of text per language
    (in expectation, chosen by a hash of text and id). It is drawn from all texts: as a
    whole, or by pieces of ``DRAWN_BYTES`` spread over the text if that is over an
    eighth of the bound. All languages are learned; the trees grow with their number.
    """
    usable = docs.where("text is not null and lang is not null").select(
        "text", "lang", F.octet_length("text").alias("size"), F.xxhash64("doc_id", "text").alias("seed")
    )
    total = F.greatest(F.sum("size"), F.lit(1))
    shares = usable.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample_bytes)) / total).alias("share"))
    draw = F.pmod("seed", F.lit(1 << 30)) / float(1 << 30)
    sample = usable.join(F.broadcast(shares), "lang").withColumn("cut", F.col("size") > sample_bytes // 8)
    sample = sample.where(F.col("cut") | (draw < F.col("share"))).select("text", "lang", "seed", "share", "cut")
    counted = sample.mapInArrow(_word_counts, "lang string, word string, n long")
    table = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word")
    return Trees(table.toLocalIterator())


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    folded = data | 32
    plain = np.concatenate(([0], np.cumsum((folded >= 97) & (folded <= 122))))
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        part = data[offsets[row] : offsets[row + 1]]
        if part.max() >= 128:
            found[row] = any(c.isalpha() for c in part.tobytes().decode("utf-8", "ignore"))
    return found


class Predictor:
    """Predictions for batches of one task, which remembers words between them."""

    def __init__(self, trees: Trees):
        n_langs = len(trees.languages)
        self.trees, self.hasher = trees, Hasher()
        self.names = np.array([*trees.languages, UNKNOWN], object)
        most = max(1 << 12, REMEMBERED // max(1, n_langs))
        self.known_words = Remembered(most, (n_langs,), np.float64)
        self.known_windows = Remembered(most, (n_langs,), np.float32)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of every text of ``column``."""
        n_langs, n_rows = len(self.trees.languages), len(column)
        data, offsets = flat(column)
        known = _has_letter(data, offsets) & (n_langs > 0)
        if not known.any():
            return self.names[np.full(n_rows, n_langs)], np.zeros(n_rows)
        starts, ends, rows = words(data, offsets)
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        keys, first, which = np.unique(self.hasher(data, starts, ends), return_index=True, return_inverse=True)
        total = np.zeros((n_rows, n_langs))
        step = max(1, AT_ONCE // n_langs)
        for lo in range(0, len(keys), step):
            start, end = starts[first[lo : lo + step]], ends[first[lo : lo + step]]
            per_word = self.known_words.get(
                keys[lo : lo + step],
                lambda fresh: self.trees.bits(*gather(folded, start[fresh], end[fresh]), self.known_windows),
            )
            mine = slice(None) if len(keys) <= step else (which >= lo) & (which < lo + step)
            row, word = rows[mine], which[mine] - lo
            for i in range(n_langs):
                total[:, i] += np.bincount(row, per_word[word, i], n_rows)
        share = np.exp2(-np.minimum(total - total.min(axis=1, keepdims=True), 1000.0))
        best = np.where(known, total.argmin(axis=1), n_langs)
        return self.names[best], np.where(known, 1.0 / share.sum(axis=1), 0.0)


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(shared.value)
        for batch in pieces(batches, "text"):
            langs, scores = predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def _accepted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(shared.value)
        learned = bool(shared.value.languages)
        for batch in pieces(batches, "text"):
            if not learned:
                yield batch.filter(pa.array(_has_letter(*flat(batch.column("text")))))
                continue
            langs, _ = predict(batch.column("text"))
            at = batch.schema.get_field_index("lang")
            stated = batch.column("lang")
            filled = pa.array([p if s is None else s for s, p in zip(stated.to_pylist(), langs)], pa.string())
            yield batch.set_column(at, "lang", filled).filter(pa.array(langs != UNKNOWN))

    return run


def identify(spark: SparkSession, docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs (doc_id, text, ...)``.

    The language is that with the shortest code for the whole text (ties: the smaller
    name); the score is its share in the likelihood of all. A text that is null, or
    holds no letter, gets ``und`` and 0, and so does every text if nothing was learned.
    Only the text decides; other columns are ignored. Very long texts are coded whole,
    one at a time. Each row gives a row, by its own text; an empty table gives none.
    """
    model = spark.sparkContext.broadcast(trees)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_predicted(model), "doc_id long, lang_pred string, score double")


def accepted(spark: SparkSession, docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs`` whose text is in a language, ``lang`` filled in where null.

    Texts that get ``und`` are left out; a stated language is never changed. If no
    language was learned, all texts that hold a letter stay, ``lang`` as it is.
    """
    return docs.mapInArrow(_accepted(spark.sparkContext.broadcast(trees)), docs.schema)
