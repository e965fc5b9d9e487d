"""Toxicity: a linear-chain conditional random field tags toxic tokens.

Only documents are labelled, so tokens are labelled first: in toxic documents of a
bounded sample those tokens whose word, or whose word's beginning, stands in far more
toxic documents than clean ones; all tokens of clean documents are clean. The field is
trained on these sequences. Over whole texts, forward and backward sums give every
token's marginal chance of being toxic; likely tokens are the offending spans, and the
marginals of a document, set against labelled documents that the field did not see,
give its score.

A chain of two labels moves the odds of the labels by a Moebius map per token. Maps
compose, so a batch of chains is scanned in blocks: as many steps as a block is long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.ragged import PIECE_BYTES, U64, Hasher, flat, mix, pieces, runs
from tickloom.llm.store import removed, written

#: Labelled documents of either class that the field is trained on, and their bytes.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1_500_000
#: A longer document of the sample gives so many bytes, as pieces spread over its text.
PASSAGE_BYTES = 16_000
#: Labelled documents, in their natural shares, that scores are calibrated on.
CALIBRATION_ROWS = 6000
#: One labelled document in so many is kept for calibration.
CALIBRATION_SHARE = 4

#: Weights of the field: features are hashed to so many bits.
SLOT_BITS = 18
#: Bytes at the beginning and at the end of a word that are features of their own.
HEADS = (3, 4, 5, 6, 8)
TAILS = (3, 5)
#: A token is labelled toxic from this log-odds on, less so many standard errors, if it
#: has this share of the most that any token of its document has.
EVIDENCE = 0.5
ERRORS = 1.5
RELATIVE = 0.6
SWEEPS = 40
#: Scores from here on are predicted toxic; marginals from here on are spans.
TOXIC_SCORE = 0.7
TOXIC_TOKEN = 0.5
#: Bounds of a token's score, so that products of odds stay finite.
LARGEST = 30.0

#: Bytes of words: ASCII digits and letters, and all bytes of other characters.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def folded(data: np.ndarray) -> np.ndarray:
    """``data`` with the capitals of Latin-1 as small letters; ASCII is folded by the hash."""
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return np.where(capital, data + np.uint8(0x20), data) if capital.any() else data


def features(hasher: Hasher, data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of the tokens of some texts, and their hashed features.

    The first columns are the word and its heads, the features that label tokens; the
    last ones are the words before and after it.
    """
    starts, ends, rows = runs(_WORD[data], offsets)
    data = folded(data)
    columns = [(starts, ends)]
    columns += [(starts, np.minimum(starts + n, ends)) for n in HEADS]
    columns += [(np.maximum(ends - n, starts), ends) for n in TAILS]
    hashed = np.empty((len(starts), len(columns) + 2), U64)
    for k, (lo, hi) in enumerate(columns):
        hashed[:, k] = hasher(data, lo, hi)
    first = np.ones(len(starts), bool)
    first[1:] = rows[1:] != rows[:-1]
    last = np.ones(len(starts), bool)
    last[:-1] = first[1:]
    word = hashed[:, 0]
    hashed[:, -2] = np.where(first, U64(0), np.concatenate((word[:1], word[:-1])))
    hashed[:, -1] = np.where(last, U64(0), np.concatenate((word[1:], word[-1:])))
    hashed = mix(hashed + np.arange(hashed.shape[1], dtype=U64) * U64(0x9E3779B97F4A7C15))
    return starts, ends, rows, first, hashed


def _scanned(maps: np.ndarray) -> np.ndarray:
    """The odds after each of the maps ``(a, b, c, d): r -> (a r + b) / (c r + d)``."""
    n = len(maps)
    long = max(1, int(np.sqrt(n)))
    blocks = -(-n // long)
    whole = np.zeros((blocks * long, 4))
    whole[:, [0, 3]] = 1
    whole[:n] = maps
    whole = whole.reshape(blocks, long, 4)
    done = np.empty_like(whole)
    a, b, c, d = whole[:, 0].T
    done[:, 0] = whole[:, 0]
    for k in range(1, long):
        e, f, g, h = whole[:, k].T
        a, b, c, d = e * a + f * c, e * b + f * d, g * a + h * c, g * b + h * d
        scale = 1 / np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
        done[:, k] = np.stack((a, b, c, d), axis=1)
    before, odds = np.empty(blocks), 1.0
    for k in range(blocks):
        before[k] = odds
        a, b, c, d = done[k, -1]
        odds = (a * odds + b) / (c * odds + d)
    at = before[:, None]
    return ((done[..., 0] * at + done[..., 1]) / (done[..., 2] * at + done[..., 3])).reshape(-1)[:n]


@dataclass
class Field:
    """Scores of the label toxic over clean: by feature, by step and at the start."""

    weights: np.ndarray
    step: np.ndarray  # [[clean to clean, clean to toxic], [toxic to clean, toxic to toxic]]
    start: float

    def sums(self, hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Odds of toxic over clean from the tokens up to each, from those after it, and own ones."""
        own = self.weights[(hashed >> U64(64 - SLOT_BITS)).astype(np.int64)].sum(axis=1) if len(hashed) else np.zeros(0)
        own = np.exp(np.clip(own, -LARGEST, LARGEST))
        move = np.exp(self.step)
        maps = np.empty((len(own), 4))
        maps[:] = np.array([move[1, 1], move[0, 1], move[1, 0], move[0, 0]])
        maps[:, :2] *= own[:, None]
        maps[first] = np.stack((np.zeros(len(own)), own * np.exp(self.start), np.zeros(len(own)), np.ones(len(own))), axis=1)[first]
        forward = _scanned(maps)
        last = np.ones(len(own), bool)
        last[:-1] = first[1:]
        after = np.append(own[1:], 1.0)
        maps = np.stack((move[1, 1] * after, np.full(len(own), move[1, 0]), move[0, 1] * after, np.full(len(own), move[0, 0])), axis=1)
        maps[last] = (0, 1, 0, 1)
        return forward, _scanned(maps[::-1])[::-1], own

    def marginals(self, hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The chance of every token to be toxic, given its whole sequence."""
        if not len(hashed):
            return np.zeros(0)
        forward, backward, _ = self.sums(hashed, first)
        return 1 - 1 / (1 + forward * backward)


def token_labels(hashed: np.ndarray, docs: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which tokens of toxic documents stand for their label.

    ``docs`` numbers the document of each token, ``toxic`` says which are toxic. A
    feature counts once a document.
    """
    best = np.full(len(docs), -np.inf)
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    for k in range(1 + len(HEADS)):
        kinds, number = np.unique(hashed[:, k], return_inverse=True)
        pairs = np.unique(number.astype(np.int64) * len(toxic) + docs)
        of_toxic = toxic[pairs % len(toxic)]
        bad = np.bincount(pairs[of_toxic] // len(toxic), minlength=len(kinds)) + 0.5
        good = np.bincount(pairs[~of_toxic] // len(toxic), minlength=len(kinds)) + 0.5
        odds = np.log(bad / (n_toxic + 1)) - np.log(good / (n_clean + 1)) - ERRORS * np.sqrt(1 / bad + 1 / good)
        best = np.maximum(best, odds[number])
    # A document's strongest tokens explain its label; weak ones need not.
    least = np.full(len(toxic), EVIDENCE)
    np.maximum.at(least, docs, RELATIVE * best)
    return toxic[docs] & (best >= least[docs])


def fitted(hashed: np.ndarray, first: np.ndarray, labels: np.ndarray, sweeps: int = SWEEPS) -> Field:
    """The field of greatest penalised likelihood for labelled sequences, by adaptive steps."""
    slots = (hashed >> U64(64 - SLOT_BITS)).astype(np.int32)
    field = Field(np.zeros(1 << SLOT_BITS), np.zeros((2, 2)), 0.0)
    inner = ~first
    before = np.append(False, labels[:-1])
    seen = np.array([[(inner & (before == i) & (labels == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    size = (1 << SLOT_BITS) + 5
    moments = np.zeros((2, size))
    values = np.zeros(size)
    for sweep in range(1, sweeps + 1):
        field = Field(values[5:], values[:4].reshape(2, 2), values[4])
        forward, backward, own = field.sums(hashed, first)
        chance = 1 - 1 / (1 + forward * backward)
        off = labels - chance
        slopes = np.empty(size)
        slopes[5:] = 0
        for k in range(slots.shape[1]):
            slopes[5:] += np.bincount(slots[:, k], weights=off, minlength=size - 5)
        move = np.exp(field.step)
        reach = np.append(1.0, forward[:-1])[inner]
        ahead = (own * backward)[inner]
        joint = np.stack((np.full(len(reach), move[0, 0]), move[0, 1] * ahead, move[1, 0] * reach, move[1, 1] * reach * ahead))
        slopes[:4] = seen.ravel() - (joint / joint.sum(axis=0)).sum(axis=1)
        slopes[4] = off[first].sum()
        slopes -= 0.05 * values
        moments[0] += 0.1 * (slopes - moments[0])
        moments[1] += 0.01 * (slopes**2 - moments[1])
        values += 0.1 * (moments[0] / (1 - 0.9**sweep)) / (np.sqrt(moments[1] / (1 - 0.99**sweep)) + 1e-8)
    return Field(values[5:].copy(), values[:4].reshape(2, 2).copy(), float(values[4]))


def summary(chance: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Per text what its score rests on: one, expected toxic tokens, the largest chance, length."""
    total = np.bincount(rows, weights=chance, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, rows, chance)
    tokens = np.bincount(rows, minlength=n)
    return np.stack((np.ones(n), np.log1p(total), most, most**4, np.log1p(total) / np.log(tokens + 3)), axis=1)


def calibrated(told: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression of ``toxic`` on ``told``, by Newton's method."""
    weights = np.zeros(told.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(told @ weights, -LARGEST, LARGEST)))
        slope = told.T @ (toxic - chance) - 0.1 * weights
        bend = (told * (chance * (1 - chance))[:, None]).T @ told + 0.1 * np.eye(told.shape[1])
        weights += np.clip(np.linalg.solve(bend, slope), -5, 5)
    return weights


@dataclass
class Model:
    """A trained field and the calibration of its scores; without a field, a constant share."""

    field: Field | None
    weights: np.ndarray
    share: float = 0.0

    def scores(self, told: np.ndarray) -> np.ndarray:
        if self.field is None:
            return np.full(len(told), self.share)
        return 1 / (1 + np.exp(-np.clip(told @ self.weights, -LARGEST, LARGEST)))


def _stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Parts of some texts that are worked on at once: bytes, offsets, rows, and their place.

    All of them together, or a single text of several megabytes by stretches of one,
    cut where a word has ended.
    """
    if len(data) <= 2 * PIECE_BYTES or len(offsets) != 2:
        yield data, offsets, np.arange(len(offsets) - 1), 0
        return
    lo = 0
    while lo < len(data):
        hi = min(lo + PIECE_BYTES, len(data))
        while hi < len(data) and _WORD[data[hi]]:
            ahead = np.flatnonzero(~_WORD[data[hi : hi + PIECE_BYTES]])
            hi = hi + int(ahead[0]) if len(ahead) else min(hi + PIECE_BYTES, len(data))
        yield data[lo:hi], np.array([0, hi - lo]), np.zeros(1, np.int64), lo
        lo = hi


def tagged(field: Field, hasher: Hasher, data: np.ndarray, offsets: np.ndarray):
    """Starts, ends, rows and marginals of all tokens of some texts, stretch by stretch."""
    for part, cuts, owners, at in _stretches(data, offsets):
        starts, ends, rows, first, hashed = features(hasher, part, cuts)
        yield starts + at, ends + at, owners[rows], field.marginals(hashed, first)


def _spans(data: np.ndarray, offsets: np.ndarray, starts, ends, rows, chance) -> dict[int, str]:
    """Per row that has any, the runs of toxic tokens as start:end in code points."""
    toxic = np.flatnonzero(chance >= TOXIC_TOKEN)
    if not len(toxic):
        return {}
    place = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    opens = np.ones(len(toxic), bool)
    opens[1:] = (np.diff(toxic) > 1) | (np.diff(rows[toxic]) > 0)
    closes = np.append(opens[1:], True)
    owner = rows[toxic[opens]]
    base = place[offsets[owner]]
    listed: dict[int, list[str]] = {}
    for row, lo, hi in zip(owner.tolist(), (place[starts[toxic[opens]]] - base).tolist(), (place[ends[toxic[closes]]] - base).tolist()):
        listed.setdefault(row, []).append(f"{lo}:{hi}")
    return {row: ",".join(spans) for row, spans in listed.items()}


def _told(field: Field, hasher: Hasher, column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Per text what its score rests on, and its spans."""
    data, offsets = flat(column)
    found = [np.concatenate(x) for x in zip(*tagged(field, hasher, data, offsets))]
    spans = _spans(data, offsets, *found)
    return summary(found[3], found[2], len(column)), [spans.get(row, "") for row in range(len(column))]


def _summaries(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, hasher = shared.value, Hasher()
        for batch in pieces(batches, "text"):
            told, _ = _told(field, hasher, batch.column("text"))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(told.ravel()), told.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), rows], names=["toxic", "told"])

    return run


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, Hasher()
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            told, spans = np.zeros((n, 1)), [""] * n
            if model.field is not None:
                told, spans = _told(model.field, hasher, batch.column("text"))
            scores = model.scores(told)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= TOXIC_SCORE).astype(np.int32)), pa.array(spans, pa.string())],
                names=["doc_id", "score", "predicted", "spans"],
            )

    return run


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts, or of long ones four pieces spread over them, cut at words' ends."""
    for batch in pieces(batches, "text"):
        texts = []
        for text in batch.column("text").cast(pa.large_binary()).to_pylist():
            size, part = len(text), PASSAGE_BYTES // 4
            if size > PASSAGE_BYTES:
                starts = [k * (size - part) // 3 for k in range(4)]
                text = b"\n".join(text[lo : lo + part] for lo in starts)
            texts.append(text.decode("utf-8", "ignore"))
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """A field and its calibration, from ``docs`` that ``labels (doc_id, toxic)`` mark 0 or 1.

    The sample is bounded: ``SAMPLE_ROWS`` documents and ``SAMPLE_BYTES`` of text of
    either class, equal texts once, and ``CALIBRATION_ROWS`` others in their natural
    shares; documents are drawn by the hash of their id. Null texts teach nothing. A
    document is toxic if any of its labels says 1; other labels but 0 are none. With
    one class only, or none, nothing is learned but the share of toxic documents.
    """
    plain = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    marks = labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = marks.join(plain.select("doc_id"), "doc_id", "left_semi")
    known = known.withColumns(
        {
            "order": F.xxhash64("doc_id", F.lit("draw")),
            "apart": F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(CALIBRATION_SHARE)) == 0,
        }
    )
    known = written(spark, known, "labelled")
    counts = dict(known.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return Model(None, np.zeros(0), float(counts.get(1, 0) > 0))
    drawn = known.where("not apart and toxic = 1").orderBy("order").limit(SAMPLE_ROWS)
    drawn = drawn.unionByName(known.where("not apart and toxic = 0").orderBy("order").limit(SAMPLE_ROWS))
    apart = known.where("apart").orderBy("order").limit(CALIBRATION_ROWS)
    # Bounded by the parameters above, whatever the corpus.
    texts = plain.join(F.broadcast(drawn), "doc_id").dropDuplicates(["text"])
    texts = written(spark, texts.mapInArrow(_passages, texts.schema), "passages")
    running = F.sum(F.octet_length("text")).over(Window.partitionBy("toxic").orderBy("order", F.xxhash64("text")))
    sample = texts.withColumn("size", running).where(F.col("size") <= SAMPLE_BYTES).select("toxic", "text").toArrow()
    toxic = sample.column("toxic").to_numpy() == 1
    if toxic.all() or not toxic.any():
        return Model(None, np.zeros(0), counts[1] / sum(counts.values()))
    _, _, rows, first, hashed = features(Hasher(), *flat(sample.column("text").combine_chunks()))
    field = fitted(hashed, first, token_labels(hashed, rows, toxic))
    shared = spark.sparkContext.broadcast(field)
    told = plain.join(F.broadcast(apart.select("doc_id", "toxic", "order")), "doc_id")
    told = told.orderBy("order", F.xxhash64("text")).limit(CALIBRATION_ROWS).select("toxic", "text")
    told = told.mapInArrow(_summaries(shared), "toxic int, told array<double>").toArrow()
    told_toxic = told.column("toxic").to_numpy() == 1
    if told_toxic.all() or not told_toxic.any():  # too few labels to set any apart
        told = spark.createDataFrame(sample).mapInArrow(_summaries(shared), "toxic int, told array<double>").toArrow()
        told_toxic = told.column("toxic").to_numpy() == 1
    values = told.column("told").combine_chunks().flatten().to_numpy().reshape(told.num_rows, -1)
    removed(spark, known, texts)
    field.weights = field.weights.astype(np.float32)
    return Model(field, calibrated(values, told_toxic.astype(float)))


def find_toxic(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and spans of every row of ``docs (doc_id, text)``.

    ``score`` is the chance that a document is labelled toxic, ``predicted`` whether it
    reaches ``TOXIC_SCORE``, ``spans`` the places of its toxic tokens, as start:end in
    code points, ends exclusive, comma-joined.

    Null texts are empty; empty texts and those without a word have no spans and the
    score of a document without toxic tokens. A text of more than two megabytes is
    tagged by stretches of one, cut between words, whose sums make one score. Each row
    gives a row, by its own text, and equal texts get equal scores; an empty table
    gives none. Other columns are ignored.
    """
    shared = spark.sparkContext.broadcast(model)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_scorer(shared), "doc_id long, score double, predicted int, spans string")
