"""Token counts under a published BPE vocabulary: rank-synchronous merging of arrays.

The pre-tokens of a batch lie one after the other in one array of symbols. In every
round each pre-token's lowest-ranked pair is found and applied, for all pre-tokens at
once; a pre-token without a ranked pair is done and counts its symbols. White space
separates pre-tokens, so the work is done per distinct word and its counts summed.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import Hasher, Remembered, flat, gather, pieces, strings, words

#: The longest context that the counted texts are meant for.
TOKEN_LIMIT = 2048
#: Distinct words whose counts a task remembers between batches.
REMEMBERED_WORDS = 1 << 20
#: How many words' pre-tokens are merged at once.
MERGED_WORDS = 1 << 16


class Vocabulary:
    """Merge ranks as sorted arrays, and the symbols of single bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, ids = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        # The printable stand-ins of bytes in byte-level vocabularies.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.inner = np.array([ids[letter[b]] for b in range(256)], np.int64)
        self.final = np.array([ids[letter[b] + suffix] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], np.arange(len(keys))[order], made[order]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = split.replace(r"\s", r"\p{White_Space}") + r"|\n"
        self.special = [t["content"] for t in spec["added_tokens"]]
        # With every part older than the pair it joins, equal pairs may go at once.
        born = np.zeros(max(ids.values()) + 1, np.int64) - 1
        born[made] = np.arange(len(made))
        parts = np.array([[ids[a], ids[b]] for a, b in merges])
        if not (born[parts].max(axis=1) < np.arange(len(merges))).all():
            raise ValueError("a merge is ranked before one of its parts")

    def counts(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Symbols left of each ragged row when no ranked pair remains."""
        done = np.diff(offsets).astype(np.int64)
        row = np.repeat(np.arange(len(done)), done)
        never = len(self.keys)
        while len(symbols) > 1:
            pair = (symbols[:-1] << 20) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), never - 1)
            rank = np.where((self.keys[at] == pair) & (row[:-1] == row[1:]), self.ranks[at], never)
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            lowest = np.minimum.reduceat(np.append(rank, never), first)
            lengths = np.diff(np.append(first, len(symbols)))
            least = np.repeat(lowest, lengths)
            hit = (rank == least[:-1]) & (rank < never)
            # In a chain of overlapping hits, every second one from its left end goes.
            index = np.arange(len(hit))
            opens = hit & ~np.concatenate(([False], hit[:-1]))
            chain = np.maximum.accumulate(np.where(opens, index, -1))
            hit &= (index - chain) % 2 == 0
            joined = np.flatnonzero(hit)
            symbols[joined] = self.made[at[joined]]
            keep = least < never
            keep[joined + 1] = False
            np.subtract.at(done, row[joined], 1)
            symbols, row = symbols[keep], row[keep]
        return done

    def word_counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each word; a word holds no white space of ``BLANK``."""
        special = [sum(t.count(s) for s in self.special) if "<|" in t else 0 for t in texts]
        if any(special):
            either = "|".join(map(regex.escape, self.special))
            parts = [regex.split(either, t) if n else [t] for t, n in zip(texts, special)]
        else:
            parts = [[t] for t in texts]
        joined = unicodedata.normalize("NFC", "\n".join("\n".join(p) for p in parts))
        folded = "".join(c.lower() for c in joined) if "Σ" in joined else joined.lower()
        found = regex.findall(self.pattern, folded)
        number: dict[str, int] = {}
        taken = np.array([number.setdefault(t, len(number)) for t in found], np.int64)
        distinct = "".join(number).encode("utf-8")
        sizes = np.array([len(t.encode("utf-8")) for t in number], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        data = np.frombuffer(distinct, np.uint8)
        symbols = self.inner[data]
        ends = offsets[1:] - 1
        symbols[ends] = self.final[data[ends]]
        per_token = self.counts(symbols, offsets)
        breaks = taken == number.get("\n", -1)
        per_token = np.append(per_token, 0)
        if "\n" in number:
            per_token[number["\n"]] = 0
        of_part = np.concatenate(([0], np.cumsum(breaks)))[:-1]
        n_parts = sum(map(len, parts))
        of_part_counts = np.bincount(of_part, per_token[taken], n_parts).astype(np.int64)
        of_word = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return np.bincount(of_word, of_part_counts, len(texts)).astype(np.int64) + np.array(special, np.int64)


def _counter(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, hasher = vocabulary.value, Hasher(fold_case=False)
        remembered = Remembered(REMEMBERED_WORDS)
        for batch in pieces(batches, "text"):
            data, offsets = flat(batch.column("text"))
            starts, ends, rows = words(data, offsets)
            hashes, first, which = np.unique(hasher(data, starts, ends), return_index=True, return_inverse=True)

            def merged(fresh: np.ndarray) -> np.ndarray:
                parts = [p for p in np.array_split(first[fresh], len(fresh) // MERGED_WORDS + 1) if len(p)]
                texts = [strings(*gather(data, starts[p], ends[p])).to_pylist() for p in parts]
                return np.concatenate([vocab.word_counts(t) for t in texts])

            counts = remembered.get(hashes, merged)
            totals = np.bincount(rows, counts[which], batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(totals)],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs (doc_id, text)``.

    Counts are those of the vocabulary's own library for the whole text, without begin
    or end tokens; special tokens spelled out in a text count one each. The vocabulary
    is read by the driver and sent to the tasks (about 1 MB, fixed). A null text counts
    as empty: no bytes, no tokens, not over the limit. Very long texts are counted whole,
    one at a time. Equal rows, also those with equal ids, each give a row; an empty table
    gives none. Other columns are ignored.
    """
    vocabulary = spark.sparkContext.broadcast(Vocabulary(vocabulary_path))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = plain.mapInArrow(_counter(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
