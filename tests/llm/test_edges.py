"""Rows that used to be lost, misplaced or to stop a job."""

from __future__ import annotations

import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_texts import by_patterns, prose, table
from tickloom.llm import leaks, near_text, pii, vectors


def test_addresses_with_thousands_of_zeros_are_read(monkeypatch):
    assert pii.base_spans("0" * 5000 + ".1.2.3") == [(1, 0, 5006)]
    assert pii.base_spans("1.2." + "0" * 9000 + "255.4") == [(1, 0, 9009)]
    assert pii.base_spans("1.2." + "0" * 9000 + "256.4") == []
    assert pii.base_spans("1.2." + "9" * 9000 + ".4") == []


def test_long_runs_of_digits_and_dots_equal_the_patterns():
    before = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)
    try:
        source = random.Random(6)
        for letters in ("0.", "01.", "0000.1", "12 34.-", "+0 1.("):
            for size in (50, 700, 10_000):
                text = "".join(source.choice(letters) for _ in range(size))
                assert pii.base_spans(text) == by_patterns(text)
    finally:
        sys.set_int_max_str_digits(before)


def test_all_texts_under_one_id_are_compared(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "word"])), (3, " ".join([*b, "word"])), (4, " ".join(prose(3, 40)))]
    for order in (rows, rows[::-1]):
        got = sorted((r["doc_id"], r["component_id"]) for r in near_text.near_duplicates(spark, table(spark, order)).collect())
        assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_repeated_ids_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK_MEMBERS", 4)
    base = prose(5, 200)
    rows = [(k % 20, " ".join(base[:100] + prose(900 + k, 3) + base[100:])) for k in range(60)]
    rows += [(100 + k, " ".join(prose(50 + k, 60))) for k in range(20)] + [(5, " ".join([*prose(57, 60), "more"]))]
    got = {}
    for r in near_text.near_duplicates(spark, table(spark, rows)).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert all(got[k] == {0} for k in range(20)) and got[107] == {0}
    assert all(got[100 + k] == {100 + k} for k in range(20) if k != 7)


ITEMS = [(i, " ".join(prose(1000 + i, 24))) for i in range(6)]


def leaked(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = leaks.find_leaks(spark, docs, benchmark).collect()
    return {r["doc_id"]: (r["item_ids"], r["overlap"], r["short_items"]) for r in found}


def test_blocks_find_what_one_search_finds_whatever_the_order_of_rows(spark, monkeypatch):
    rows = [(k, " ".join(prose(5000 + k, 60))) for k in range(40)]
    rows += [(100 + i, f"{' '.join(prose(i, 20))} {text} {' '.join(prose(70 + i, 9))}") for i, text in ITEMS]
    # Rows come in another order each time they are read.
    docs = table(spark, rows).repartition(7, F.rand())
    whole = leaked(spark, docs, ITEMS)
    assert {d: x[0] for d, x in whole.items() if x[0]} == {100 + i: [i] for i in range(6)}
    passes, feature = [], leaks._features
    monkeypatch.setattr(leaks, "_features", lambda shared: passes.append(1) or feature(shared))
    monkeypatch.setattr(leaks, "BLOCK_BYTES", 200)
    for _ in range(2):
        assert leaked(spark, docs, ITEMS) == whole
    assert len(passes) == 2  # one pass over the texts each, for six blocks


def test_items_of_few_words_are_probed_word_for_word(spark, monkeypatch):
    items = [*ITEMS, (20, "Blue whale"), (21, "blue, WHALE song!"), (22, "paris"), (23, "one two three four"), (24, "whale blue"), (25, "...")]
    rows = [
        (1, "a blue whale song in paris."),
        (2, "blue\nwhale blue -- whale"),
        (3, "blue the whale; one two three, five four"),
        (4, "xx one two three four yy one two three four"),
        (5, "parisian blues"),
        (6, None),
        (7, f"blue whale {ITEMS[2][1]} paris"),
    ]
    want = {1: [20, 21, 22], 2: [20, 24], 3: [], 4: [23], 5: [], 6: [], 7: [20, 22]}
    for size in (1 << 18, 20):
        monkeypatch.setattr(leaks, "BLOCK_BYTES", size)
        found = leaked(spark, table(spark, rows), items)
        assert {d: x[2] for d, x in found.items()} == want
        assert {d: x[0] for d, x in found.items() if x[1]} == {7: [2]}
    only = leaked(spark, table(spark, rows), items[6:])
    assert {d: x[2] for d, x in only.items()} == want and not any(x[1] for x in only.values())


def test_sums_in_two_steps_equal_sums_in_one(spark, monkeypatch):
    rows = [(k, " ".join(prose(k % 30, 50)) + " " + ITEMS[k % 6][1]) for k in range(200)]
    docs = table(spark, rows).repartition(12)
    whole = leaked(spark, docs, ITEMS)
    monkeypatch.setattr(leaks, "SUMMED", 2)
    assert leaked(spark, docs, ITEMS) == whole


@pytest.mark.parametrize("scale", [1e-300, 1e-160, 1.0, 1e160, 1e300])
def test_vectors_whose_squares_leave_the_range_of_doubles_link(spark, scale):
    source = np.random.default_rng(1)
    base = source.normal(size=(6, 8))
    rows = [(k, [float(x) * scale for x in base[k // 3] + 0.001 * source.normal(size=8)], 1) for k in range(18)]
    rows += [(50, [0.0] * 8, 1), (51, [5e-324] * 8, 1), (52, [1e-323] * 8, 1), (53, [math.inf] + [0.0] * 7, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert all(got[k] == (2, k - k % 3) for k in range(18))
    assert got[50] == (0, 50) and got[53] == (0, 53) and got[51] == got[52] == (1, 51)


def test_scaling_leaves_cosines_as_they_are():
    matrix = np.random.default_rng(2).normal(size=(50, 16))
    plain, other = (m / np.sqrt((m * m).sum(axis=1))[:, None] for m in (matrix, vectors.scaled(matrix)))
    assert (plain @ plain.T == other @ other.T).all()


def test_a_large_group_is_not_compared_with_itself(spark, monkeypatch):
    """Near copies and one stranger in their buckets: rows in the block stage, per member."""
    per_member = {}
    for n in (300, 900):
        base = prose(5, 240)
        rows = [(k, " ".join([*base[: 3 + k % 200], "zz" + str(k), *base[3 + k % 200 :]])) for k in range(n)]
        rows.append((n, " ".join([*base[:225], *prose(6, 60)])))  # shares buckets, but is too far away
        seen = []
        monkeypatch.setattr(near_text, "BLOCK_MEMBERS", 16)
        joining = near_text._joining

        def counted(percent):
            run = joining(percent)
            count = spark.sparkContext.accumulator(0)
            seen.append(count)

            def watched(batches):
                def passing():
                    for batch in batches:
                        count.add(batch.num_rows)
                        yield batch

                yield from run(passing())

            return watched

        monkeypatch.setattr(near_text, "_joining", counted)
        got = {r["doc_id"]: r["component_id"] for r in near_text.near_duplicates(spark, table(spark, rows)).collect()}
        monkeypatch.setattr(near_text, "_joining", joining)
        assert all(got[k] == 0 for k in range(n)) and got[n] == n
        per_member[n] = seen[0].value / n
    assert per_member[900] <= 1.5 * per_member[300] + 1


def test_counts_beyond_what_a_task_holds_are_kept_whole(monkeypatch):
    import pyarrow as pa

    from tickloom.llm import lm

    words, counts = ["a", "bc", "the"], [5, 1000, 17]
    batch = pa.RecordBatch.from_pydict({"state": pa.array([0, 1, 2], pa.int32()), "word": words, "n": counts})

    class Shared:
        value = lm.marked(words, [])

    def summed():
        total = {}
        for part in lm._tables(Shared)(iter([batch, batch])):
            for p, b, packed in zip(*(part.column(c).to_pylist() for c in ("predictor", "block", "counts"))):
                total[p, b] = total.get((p, b), 0) + lm._unpacked(packed).astype(np.int64)
        return total

    whole = summed()
    monkeypatch.setattr(lm, "MOST_COUNTED", 300)
    parts = summed()
    assert whole.keys() == parts.keys() and all((whole[k] == parts[k]).all() for k in whole)


@pytest.mark.parametrize("n", [1, 2, 50, 5000])
def test_numbers_of_words_are_their_places_however_crowded(n):
    source = np.random.default_rng(n)
    vocabulary = np.unique(np.concatenate((source.integers(0, 1 << 63, n, np.uint64) * np.uint64(2), np.arange(n // 2, dtype=np.uint64))))
    asked = np.concatenate((source.choice(vocabulary, 300), source.integers(0, 1 << 63, 300, np.uint64), vocabulary[[0, -1]]))
    asked = np.append(asked, [np.uint64(0), np.uint64(2**64 - 1)]).astype(np.uint64)
    known, places = leaks.Numbers(vocabulary)(asked)
    assert known.tolist() == np.flatnonzero(np.isin(asked, vocabulary)).tolist()
    assert places.tolist() == np.searchsorted(vocabulary, asked[known]).tolist()
    assert [len(found) for found in leaks.Numbers(vocabulary)(asked[:0])] == [0, 0]


def test_windows_end_with_their_text_in_the_row_beyond():
    slot, start, last = np.arange(10, 16), np.array([0, 2, 5]), np.array([3, 4, 6])
    found = [leaks._further(slot, start, last, k, 99).tolist() for k in (1, 2, 3)]
    assert found == [[11, 13, 99], [12, 99, 99], [99, 99, 99]]
