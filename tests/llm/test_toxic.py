"""The toxicity field against enumeration, odd rows, and labels it has not seen."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries, toxic
from tickloom.llm.ragged import Hasher, flat

WORDS = "the of and lyre ander shone oust tion ering hest".split()


def hashes(texts):
    return toxic.features(Hasher(), *flat(pa.array(texts, pa.string())))


def some_field(seed=0):
    source = np.random.default_rng(seed)
    return toxic.Field(source.normal(size=1 << toxic.SLOT_BITS), source.normal(size=(2, 2)), float(source.normal()))


def by_enumeration(field, hashed, first):
    """Marginals by all labellings of every sequence."""
    own = field.weights[(hashed >> np.uint64(64 - toxic.SLOT_BITS)).astype(np.int64)].sum(axis=1)
    chance = np.zeros(len(own))
    borders = [*np.flatnonzero(first), len(own)]
    for lo, hi in zip(borders[:-1], borders[1:]):
        total = 0.0
        for labels in product((0, 1), repeat=hi - lo):
            score = field.start * labels[0] + sum(own[lo + k] for k, label in enumerate(labels) if label)
            weight = np.exp(score + sum(field.step[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            chance[lo:hi] += weight * np.array(labels)
        chance[lo:hi] /= total
    return chance


def test_marginals_equal_enumeration():
    source = np.random.default_rng(1)
    texts = [" ".join(source.choice(WORDS, n)) for n in (1, 7, 0, 9, 2, 3)]
    starts, ends, rows, first, hashed = hashes([*texts, None, " ,;", "é Étage étage"])
    field = some_field()
    assert np.allclose(field.marginals(hashed, first), by_enumeration(field, hashed, first), atol=1e-12)
    assert len(rows) == 22 + 3 and hashed[-1, 0] == hashed[-2, 0]


def test_marginals_of_long_chains_equal_a_plain_recursion():
    source = np.random.default_rng(2)
    text = " ".join(source.choice(WORDS, 5000))
    _, _, _, first, hashed = hashes([text, "x", text])
    field = some_field(3)
    own = field.weights[(hashed >> np.uint64(64 - toxic.SLOT_BITS)).astype(np.int64)].sum(axis=1)
    step = np.exp(field.step)
    for lo, hi in ((0, 5000), (5001, 10001)):
        forward = np.zeros((hi - lo, 2))
        forward[0] = [1, np.exp(own[lo] + field.start)]
        for k in range(1, hi - lo):
            forward[k] = (forward[k - 1] / forward[k - 1].sum()) @ step * [1, np.exp(own[lo + k])]
        backward = np.ones((hi - lo, 2))
        for k in range(hi - lo - 2, -1, -1):
            backward[k] = step @ (backward[k + 1] * [1, np.exp(own[lo + k + 1])])
            backward[k] /= backward[k].sum()
        both = forward * backward
        assert np.allclose(field.marginals(hashed, first)[lo:hi], both[:, 1] / both.sum(axis=1), atol=1e-9)


def test_training_raises_the_likelihood_and_finds_the_labels():
    source = np.random.default_rng(4)
    texts, bad = [], []
    for k in range(200):
        words = list(source.choice(WORDS, 20))
        if k % 4 == 0:
            words[source.integers(20)] = "Grunz!" if k % 8 else "schnarch"
        bad.append(k % 4 == 0)
        texts.append(" ".join(words))
    starts, _, rows, first, hashed = hashes(texts)
    labels = toxic.token_labels(hashed, rows, np.array(bad))
    assert labels.sum() == 50 and sorted(rows[labels]) == list(range(0, 200, 4))
    field = toxic.fitted(hashed, first, labels)
    chance = field.marginals(hashed, first)
    assert chance[labels].min() > 0.9 and chance[~labels].max() < 0.1
    _, _, _, first, hashed = hashes(["the Grunzen of"])  # a word it never saw, by its head
    chance = field.marginals(hashed, first)
    assert chance[1] > 100 * max(chance[0], chance[2])


def test_a_long_text_is_tagged_by_stretches(monkeypatch):
    field = some_field(5)
    field.step[:], field.start = 0, 0.0  # then no cut changes a marginal, but for neighbours
    text = " ".join(np.random.default_rng(6).choice(WORDS, 9000))
    data, offsets = flat(pa.array([text]))
    whole = [np.concatenate(x) for x in zip(*toxic.tagged(field, Hasher(), data, offsets))]
    monkeypatch.setattr(toxic, "PIECE_BYTES", 5000)
    parts = [np.concatenate(x) for x in zip(*toxic.tagged(field, Hasher(), data, offsets))]
    for a, b in zip(whole[:3], parts[:3]):
        assert (a == b).all()
    assert (np.abs(whole[3] - parts[3]) > 1e-9).sum() <= 2 * (len(data) // 5000 + 1)
    monkeypatch.setattr(toxic, "PIECE_BYTES", 10)
    giant = flat(pa.array(["x" * 1000 + " y"]))
    assert [list(s) for s, *_ in toxic.tagged(field, Hasher(), *giant)] == [[0], [1001]]


def test_odd_rows_and_spans(spark):
    field = toxic.Field(np.zeros(1 << toxic.SLOT_BITS), np.zeros((2, 2)), -5.0)
    field.step[:, 1] = -5
    _, _, _, _, hashed = hashes(["idiot"])
    field.weights[(hashed[0, :1] >> np.uint64(64 - toxic.SLOT_BITS)).astype(np.int64)] = 25
    model = toxic.Model(field, np.array([-4.0, 0, 8, 0, 0]))
    rows = [(1, "é IDIOT idiot, der idiot"), (2, None), (3, ""), (4, " .\n"), (None, "Idiot"), (1, "clean"), (5, "a " * 1_500_000 + "idiot"), (6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "spans": F.lit(1), "toxic": F.lit(1)})
    got = {(r["doc_id"], r["spans"]): (round(r["score"], 2), r["predicted"]) for r in toxic.find_toxic(spark, docs, model).collect()}
    assert got == {
        (1, "2:13,19:24"): (0.98, 1),
        (2, ""): (0.02, 0),
        (3, ""): (0.02, 0),
        (4, ""): (0.02, 0),
        (None, "0:5"): (0.98, 1),
        (1, ""): (0.02, 0),
        (5, "3000000:3000005"): (0.98, 1),
        (6, ""): (0.02, 0),
    }
    assert toxic.find_toxic(spark, docs.limit(0), model).count() == 0


@pytest.mark.parametrize(("labels", "share"), [([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(None, 1), (99, 1), (1, 7)], 0.0)])
def test_one_class_teaches_its_share_only(spark, labels, share):
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("t"))
    model = toxic.train(spark, docs, labels)
    assert model.field is None
    assert {r["score"] for r in toxic.find_toxic(spark, docs, model).collect()} == {share}


def test_held_out_labels_are_found(spark):
    sf = "/root/testdata/sf0.1"
    judged = queries.op12_toxicity(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    shares = judged.join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted")).collect()
    shares = dict(map(tuple, shares))
    assert shares[1] > 0.85 and shares[0] < 0.01
