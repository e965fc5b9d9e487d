"""Scores worked out word by word and bit by bit, and what words share."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import lm
from tickloom.llm.ragged import Hasher, flat


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return lm._spelled(*flat(pa.array(words, pa.string())))


def some_pairs(n: int, seed: int = 3) -> list[tuple[int, str, int]]:
    source = random.Random(seed)
    ends = ["", "a", "ab", "abba", "b" * 70000, "éé", "z" * 300]
    found = {(source.randrange(3), source.choice("abc") * source.randrange(1, 4) + source.choice(ends)) for _ in range(n)}
    return [(s, w, source.randrange(1, 9)) for s, w in sorted(found, key=lambda p: (p[0], p[1].encode()))]


@pytest.mark.parametrize("ordered", [True, False])
def test_branches_stand_for_equal_prefixes_of_one_state(ordered):
    pairs = [p for p in some_pairs(120) if len(p[1]) < 400]
    if not ordered:
        random.Random(1).shuffle(pairs)
    data, offsets = spelled([w for _, w, _ in pairs])
    states = np.array([s for s, _, _ in pairs])
    fresh, owner = lm.branches(data, offsets, states)
    place = {}
    for row, (state, _, _) in enumerate(pairs):
        for at in range(offsets[row], offsets[row + 1]):
            place[at] = state, bytes(data[offsets[row] : at + 1])
    assert [place[fresh[number]] for number in owner] == [place[at] for at in range(len(data))]
    assert list(owner[fresh]) == list(range(len(fresh)))
    if ordered:
        assert len(fresh) == len(set(place.values())) < len(data)


def test_branches_of_nothing_and_of_very_long_words():
    none = np.zeros(0, np.int64)
    assert [len(x) for x in lm.branches(np.zeros(0, np.uint8), np.zeros(1, np.int64), none)] == [0, 0]
    data, offsets = spelled(["a" * 70000, "a" * 70000 + "b"])
    fresh, owner = lm.branches(data, offsets, np.zeros(2, np.int64))
    assert len(fresh) == 70001 + 2 and list(fresh[owner[-3:]]) == [69999, len(data) - 2, len(data) - 1]


def test_what_leaves_the_state_out_is_looked_up_once_for_all_states(monkeypatch):
    """Look-ups of a pass: per beginning of a word, or per state and beginning, whatever the pairs."""
    stock = ["stone", "stones", "stoned", "river", "é"]
    pairs = sorted((w, s) for w in stock for s in range(5) if (w, s) != ("river", 2))
    batch = pa.RecordBatch.from_pydict(
        {"state": pa.array([s for _, s in pairs], pa.int32()), "word": [w for w, _ in pairs], "n": pa.array([3] * len(pairs), pa.int64())}
    )
    begun = {(w.encode() + b" ")[:k] for w in stock for k in range(1, len(w.encode()) + 2)}
    after = {(s, (w.encode() + b" ")[:k]) for w, s in pairs for k in range(1, len(w.encode()) + 2)}
    entries, seen = lm._entries, []
    monkeypatch.setattr(lm, "_entries", lambda contexts, *more: (seen.append(len(contexts)), entries(contexts, *more))[1])

    class Shared:
        value = lm.Odds([np.zeros((1 << size, 2), np.float32) for size in lm.SLOT_BITS], {})

    weights = np.full((8, lm.N_PREDICTORS, lm.CONFIDENCES), 1.0 / lm.N_PREDICTORS, np.float32)
    assert len(list(lm._gradients(Shared, weights, True)(iter([batch])))) == 1
    assert sorted(seen) == [len(begun)] * 4 + [len(after)] * 3
    ((nodes, _),) = lm._nodes(iter([batch]))
    assert nodes.heavy.sum() == 3 * sum(len(w.encode()) + 1 for w, _ in pairs)


def test_pairs_are_added_up_over_pieces_of_text():
    texts = pa.RecordBatch.from_pydict({"text": ["the river " * 120000, "the river " * 120000, "River", None]})
    (told,) = lm._pairs(iter([texts]))
    rows = list(zip(*(told.column(c).to_pylist() for c in ("state", "word", "n"))))
    assert len({r[:2] for r in rows}) == len(rows)
    found = Counter()
    for _, word, n in rows:
        found[word] += n
    assert found == {"the": 240000, "river": 240001, lm.END: 4}


def test_frequent_words_are_found_by_their_hashes():
    mixer = lm.Mixer([np.zeros((1 << size, 2), np.float32) for size in lm.SLOT_BITS], {})
    mixer.freeze([np.zeros((1 << size, 2), np.float32) for size in lm.SLOT_BITS])
    costs = pa.table({"key": pa.array([], pa.int64()), "state": pa.array([], pa.int32()), "cost": pa.array([], pa.float32())})
    for n in (0, 1, 3000):
        listed = pa.table({"word": pa.array([f"w{i}" for i in range(n)], pa.string()), "count": pa.array(range(n), pa.int64())})
        frequent = lm.Frequent(listed, 1, costs, mixer)
        hashes = lm._keys(pa.array([f"w{i}" for i in range(3500)], pa.string()))
        at, there = frequent.places(np.append(hashes, np.array([0, 2**64 - 1], np.uint64)))
        assert list(np.flatnonzero(there)) == list(range(n)) and list(frequent.counts[at[there]]) == list(range(n))


def test_sums_of_words_together_equal_those_of_words_alone():
    """Counts, slopes and costs do not depend on which words share a piece, or on their order."""
    pairs = [p for p in some_pairs(150) if len(p[1]) < 400]
    marks = lm.marked(["a", "ab", "bb"], [(1, "cab"), (2, "a")])

    class Shared:
        value = marks

    def batch(some):
        states, words, n = zip(*some)
        return pa.RecordBatch.from_pydict({"state": pa.array(states, pa.int32()), "word": list(words), "n": pa.array(n, pa.int64())})

    def tables(parts):
        sums = [np.zeros((1 << size, 2)) for size in lm.SLOT_BITS]
        for part in parts:
            for told in lm._tables(Shared)(iter([batch(part)])):
                for p, b, packed in zip(*(told.column(c).to_pylist() for c in ("predictor", "block", "counts"))):
                    sums[p][b << lm.BLOCK_BITS : (b + 1) << lm.BLOCK_BITS] += lm._unpacked(packed).reshape(-1, 2)
        return sums

    together, alone = tables([pairs]), tables([[p] for p in pairs[:40]] + [pairs[40:]])
    assert all((a == b).all() for a, b in zip(together, alone))
    counts = [t.astype(np.float32) for t in together]

    class Odds:
        value = lm.Odds(counts, marks)

    mixer = lm.Mixer(counts, marks)
    mixer.freeze(counts)

    def passed(parts):
        return sum(
            np.concatenate([np.frombuffer(x) for told in lm._gradients(Odds, mixer.weights, True)(iter([batch(p)])) for x in told.column("sums").to_pylist()])
            for p in parts
        )

    mixed = random.Random(2).sample(pairs, len(pairs))
    np.testing.assert_allclose(passed([pairs]), passed([mixed[:30], mixed[30:]]), rtol=1e-6, atol=1e-9)
    whole = mixer.bits(*spelled([w for _, w, _ in pairs]), np.array([s for s, _, _ in pairs]))
    single = [mixer.bits(*spelled([w]), np.array([s]))[0] for s, w, _ in pairs]
    np.testing.assert_allclose(whole, single, rtol=1e-9)


def states_of(words: list[str]) -> list[int]:
    """The state before every word and before the end."""
    state, found, hasher = 0, [], Hasher()
    for word in words:
        found.append(state)
        if len(word.encode()) <= lm.STATE_WORD_BYTES:
            data = np.frombuffer(word.encode(), np.uint8)
            state = 1 + int(hasher(data, np.array([0]), np.array([len(data)]))[0] % np.uint64(lm.STATES - 1))
    return [*found, state]


def test_scores_equal_a_count_bit_by_bit(spark, monkeypatch):
    """Counts from plain dictionaries, every bit's chance from the formulas, one at a time."""
    source, kept = random.Random(8), []
    stock = ["the", "of", "an", "to", "river", "rivers", "stone", "stones", "stoned", "lantern", "lark", "résumé"]
    texts = [" ".join(source.choice(stock) for _ in range(source.randrange(1, 25))) for _ in range(60)] + ["", "unseen wordy"]
    docs = spark.createDataFrame([(i, t, i % 5 == 2) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    learn = lm.Mixer.learn
    monkeypatch.setattr(lm.Mixer, "learn", lambda mixer, s, p, counts: (learn(mixer, s, p, counts), kept.append(mixer))[0])
    got = {r["doc_id"]: r for r in lm.score_texts(spark, docs).collect()}
    (mixer,) = kept

    pairs = {i: list(zip(states_of(t.split()), [*t.split(), lm.END])) for i, t in enumerate(texts)}
    taught = Counter(p for i, own in pairs.items() if i % 5 != 2 for p in own)
    plain: list[Counter] = [Counter() for _ in lm.SLOT_BITS]
    for (state, word), n in taught.items():
        found, bits = lm.slots(*spelled([word]), np.array([state]))
        for number, at in enumerate(found):  # in so small a table every word is followed
            for slot, bit in zip(at.ravel(), bits.ravel()):
                plain[number][int(slot), int(bit)] += n

    def cost(state: int, word: str) -> float:
        data, offsets = spelled([word])
        found, bits = lm.slots(data, offsets, np.array([state]))
        following, total = {number: True for number in mixer.marks}, 0.0
        for k, byte in enumerate(data):
            for place in range(8):
                mixed, bit = 0.0, int(bits[k, place])
                for number, at in enumerate(found):
                    slot = int(at[k, place])
                    if number in following:
                        following[number] &= bool(mixer.marks[number][slot])
                        if not following[number]:
                            continue
                    zeros, ones = plain[number][slot, 0], plain[number][slot, 1]
                    sure = min(int(2 * math.log2(1 + zeros + ones)), lm.CONFIDENCES - 1)
                    mixed += float(mixer.weights[place, number, sure]) * math.log((ones + 0.1) / (zeros + 0.1))
                mixed = max(-20.0, min(20.0, mixed))
                grid = max(0.0, min(mixed * 1.5 + lm.REFINED // 2, lm.REFINED - 1.001))
                row = mixer.refined[(1 << place) | (int(byte) >> (8 - place))]
                low = int(grid)
                refined = row[low] * (1 - (grid - low)) + row[low + 1] * (grid - low)
                chance = (refined + 1 / (1 + math.exp(-mixed))) / 2
                total -= math.log2(chance if bit else 1 - chance)
        return total

    known = Counter(w for (_, w), n in taught.items() for _ in range(n))
    for i, own in pairs.items():
        assert got[i]["n_known"] == sum(known[w] > 0 for _, w in own)
        assert math.isclose(got[i]["score"], -sum(cost(*p) for p in own) * math.log10(2), rel_tol=1e-3), i
    assert got[60]["n_tokens"] == 1


def test_whole_word_predictors_count_every_word_however_rare(spark, monkeypatch):
    monkeypatch.setattr(lm, "FOLLOWED_SHARE", 0.2, raising=False)  # words were once left out below a share
    kept, texts = [], ["the the the the the rare", "the scarce the", "the", None]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    learn = lm.Mixer.learn
    monkeypatch.setattr(lm.Mixer, "learn", lambda mixer, s, p, counts: (learn(mixer, s, p, counts), kept.append([t.sum() for t in counts]))[0])
    assert lm.score_texts(spark, docs).count() == 4
    n_bits = 8 * sum(len(w) + 1 for t in texts for w in [*(t or "").split(), lm.END])
    assert kept == [[n_bits] * lm.N_PREDICTORS]
