"""Scores and threshold of the URL filter, worked out character by character."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import urls
from tickloom.llm.queries import RULES


def contexts(address: bytes) -> list[list[tuple[int, int]]]:
    """Per character and order the context's place and the character."""
    data = np.frombuffer(address, np.uint8)
    found = urls._nodes(data, np.array([0, len(data)]))
    return [[(int(place[i]), int(data[i])) for place, _ in found] for i in range(len(data))]


def log2(tables: dict, address: bytes) -> list[float]:
    """Witten-Bell from plain counts: ``tables`` has a counter per order and context."""
    told = []
    for orders in contexts(address):
        chance = 1 / 256
        for order, (place, symbol) in enumerate(orders):
            seen = tables.get((order, place))
            if seen:
                total, kinds = sum(seen.values()), len(seen)
                chance = (seen[symbol] + kinds * chance) / (total + kinds)
        told.append(math.log2(chance))
    return told


def made_up() -> list[str]:
    source = random.Random(5)
    words = {"org": "wiki read note page text".split(), "com": "shop sale deal cart offer".split()}
    found = []
    for k in range(500):
        top = source.choice(["org", "com", "net"])
        own = words[top] if top in words else words[source.choice(["org", "com"])]
        place = source.choice(["en/", "fr/", "de/", "es/"])
        found.append(f"https://{source.choice(own)}{k % 40}.{top}/{place}{source.choice(own)}-{source.choice(own)}")
    return found


def test_scores_and_verdicts_equal_a_plain_count(spark):
    addresses = made_up()
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    kept_out = F.pmod(F.xxhash64("url"), F.lit(urls.HELD_OUT)) == 0
    apart = {r["url"] for r in pages.where(kept_out).collect()}
    rows = {r["page_id"]: r for r in urls.judge(spark, pages, RULES).collect()}
    ruled = {k: r["verdict"] for k, r in rows.items() if r["rule"] is not None}
    tables = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}
    for k, verdict in ruled.items():
        if addresses[k] not in apart:
            for orders in contexts(addresses[k].encode()):
                for order, (place, symbol) in enumerate(orders):
                    tables[verdict][order, place][symbol] += 1
    assert all(tables.values())
    for k in range(0, 500, 7):
        text = addresses[k].encode()
        gain = sum(a - b for a, b in zip(log2(tables["allow"], text), log2(tables["block"], text)))
        assert rows[k]["score"] == pytest.approx(gain / len(text), abs=1e-9)

    # The threshold: of the cuts of the grid one that errs least, the nearest to 0 of these.
    sides = {v: [rows[k]["score"] for k, own in ruled.items() if own == v and addresses[k] in apart] for v in tables}
    assert all(sides.values())
    step = 2 * urls.SCORE_RANGE / urls.SCORE_BINS
    cuts = [n * step - urls.SCORE_RANGE for n in range(urls.SCORE_BINS + 2)]

    def error(cut: float) -> float:
        below, above = (s < cut - 1e-12 for s in sides["allow"]), (s >= cut - 1e-12 for s in sides["block"])
        return sum(below) / len(sides["allow"]) + sum(above) / len(sides["block"])

    errors = [error(cut) for cut in cuts]
    least = min((abs(cut), cut) for cut, e in zip(cuts, errors) if e <= min(errors) + 1e-12)[1]
    for k, r in rows.items():
        if r["rule"] is None and abs(r["score"] - least) > 1e-9:
            assert r["verdict"] == ("allow" if r["score"] >= least else "block"), k


def test_ties_between_rules_and_repeated_rows(spark):
    rules = [("allow", "a.net", "/xy"), ("block", "net", "/xyzz"), ("block", "b.net", "/"), ("allow", "net", "/xy/")]
    rows = [(1, "s://q.a.net/xyzz"), (1, "s://q.a.net/xyzz"), (2, "s://b.net/xy/"), (None, None), (3, ""), (4, "s://b.net/" + "q" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"score": F.lit("x"), "rule": F.lit(1)})
    got = sorted((str(r["page_id"]), str(r["rule"]), r["verdict"]) for r in urls.judge(spark, pages, rules).collect())
    # Of rules as long as each other the first by its text: "a.net/xy" before "net/xyzz".
    assert got == [
        ("1", "a.net/xy", "allow"),
        ("1", "a.net/xy", "allow"),
        ("2", "net/xy/", "allow"),
        ("3", "None", "allow"),
        ("4", "b.net/", "block"),
        ("None", "None", "allow"),
    ]
    assert urls.judge(spark, pages.limit(0), rules).count() == 0
