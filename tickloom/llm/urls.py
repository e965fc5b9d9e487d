"""URL filters: rules first, then a ratio of character language models.

Addresses that a rule accepts or rejects teach two smoothed Markov models of variable
order, one per verdict. An address without a rule is judged by the difference of its
log-likelihoods under both, per character, against a threshold calibrated on addresses
that were kept out of the training.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import U64, flat, mix, pieces

#: (verdict, host, path): a rule holds for the host and all its subdomains.
Rule = tuple[str, str, str]
ORDER = 4
#: Contexts of an order share so many places, which bounds the models' size.
CONTEXT_BITS = 13
#: One labelled address in so many calibrates the threshold.
HELD_OUT = 5
SCORE_BINS = 4000
SCORE_RANGE = 20.0


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.coalesce(F.instr(url, "://") > 0, F.lit(False)), host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(F.instr(url, "://") > 0, F.lit(False)), path).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    names, verdicts = [], []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        names.append(F.when(fits, F.lit(rule_host + rule_path)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    none = F.lit(None).cast("string")
    return F.coalesce(*names, none), F.coalesce(*verdicts, none)


def _nodes(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order the contexts' places and the symbols' keys of all characters."""
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    wide = data.astype(U64) + U64(1)
    context = np.zeros(len(data), U64)
    found = []
    for order in range(ORDER + 1):
        if order:
            shifted = np.zeros(len(data), U64)
            shifted[order:] = np.where(inside[order:] >= order, wide[:-order], U64(0))
            context = context | (shifted << U64(9 * (order - 1)))
        place = (mix(context + U64(order << 56)) >> U64(64 - CONTEXT_BITS)).astype(np.int64)
        place = place if order else np.zeros(len(data), np.int64)
        found.append((place, place << 8 | data))
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "address"):
        accepted = np.array(batch.column("accepted").to_pylist(), bool)
        data, offsets = flat(batch.column("address"))
        side = np.repeat(accepted, np.diff(offsets)).astype(np.int64)
        for order, (_, keys) in enumerate(_nodes(data, offsets)):
            both, n = np.unique(keys << 1 | side, return_counts=True)
            yield pa.RecordBatch.from_pydict({"side": both & 1, "level": np.full(len(n), order), "key": both >> 1, "n": n})


class Models:
    """Counts of both models: per order sorted symbol keys, per context totals and kinds."""

    def __init__(self, table: pa.Table):
        side, level, key, n = (table.column(c).to_numpy() for c in ("side", "level", "key", "n"))
        self.levels = {}
        for which in (0, 1):
            for order in range(ORDER + 1):
                mine = (side == which) & (level == order)
                order_of = np.argsort(key[mine])
                keys, counts = key[mine][order_of], n[mine][order_of].astype(float)
                totals = np.bincount(keys >> 8, counts, 1 << CONTEXT_BITS)
                kinds = np.bincount(keys >> 8, minlength=1 << CONTEXT_BITS).astype(float)
                self.levels[which, order] = keys, counts, totals, kinds

    def log2(self, which: int, nodes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Witten-Bell: every order is smoothed by the next lower one, the lowest evenly."""
        chance = np.full(len(nodes[0][0]), 1 / 256)
        for order, (place, symbol) in enumerate(nodes):
            keys, counts, totals, kinds = self.levels[which, order]
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, symbol), len(keys) - 1)
            seen = np.where(keys[at] == symbol, counts[at], 0.0)
            new = kinds[place]
            chance = np.where(totals[place] > 0, (seen + new * chance) / np.maximum(totals[place] + new, 1), chance)
        return np.log2(chance)


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in pieces(batches, "address", 1 << 19):
            data, offsets = flat(batch.column("address"))
            nodes = _nodes(data, offsets)
            gain = models.log2(1, nodes) - models.log2(0, nodes)
            sums = np.concatenate(([0.0], np.cumsum(gain)))
            lengths = np.diff(offsets)
            score = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(lengths, 1)
            names = [n for n in batch.schema.names if n != "address"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score)], names=[*names, "score"]
            )

    return run


def _threshold(scored: DataFrame) -> float:
    """Where both verdicts of ``scored (accepted, score)`` err least, from a histogram.

    The error is the mean of both sides' shares; among equally good cuts the one
    nearest 0, which is where the models themselves put it, wins.
    """
    cell = F.floor((F.greatest(F.least("score", F.lit(SCORE_RANGE)), F.lit(-SCORE_RANGE)) + SCORE_RANGE) * (SCORE_BINS / (2 * SCORE_RANGE)))
    rows = scored.groupBy("accepted", cell.alias("cell")).count().collect()
    held = np.zeros((2, SCORE_BINS + 1))
    for accepted, place, n in rows:
        held[int(accepted), place] += n
    if not held.sum(axis=1).all():
        return 0.0
    share = held / held.sum(axis=1, keepdims=True)
    below = np.concatenate((np.zeros((2, 1)), np.cumsum(share, axis=1)), axis=1)
    error = below[1] + 1 - below[0]
    cuts = np.arange(SCORE_BINS + 2) * (2 * SCORE_RANGE / SCORE_BINS) - SCORE_RANGE
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(cuts[best[np.abs(cuts[best]).argmin()]])


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of ``pages (page_id, url)``.

    The longest rule that fits decides; else the models do: ``allow`` if the score, in
    bits per character, reaches the threshold. They learn from all addresses that a
    rule decides, but for one in ``HELD_OUT`` (by hash), which set the threshold. The
    counts are gathered per context place, so their number is bounded whatever the
    number of addresses.

    A null url, or one without ``://``, has empty host and path and fits no rule; its
    own characters are scored, a null or empty one with 0. With no labelled address on
    one side nothing is learned: all scores and the threshold are 0 and the verdict is
    ``allow``. Of rules of equal length that both fit, the one that comes first by its
    text decides; a score at the threshold is allowed. Very long addresses are scored
    whole. Each row gives a row, an empty table none; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "ruled": verdict, "address": F.coalesce("url", F.lit(""))})
    labelled = parts.where("ruled is not null").select("address", (F.col("ruled") == "allow").alias("accepted"))
    kept_out = F.pmod(F.xxhash64("address"), F.lit(HELD_OUT)) == 0
    counts = labelled.where(~kept_out).mapInArrow(_counts, "side long, level long, key long, n long")
    table = counts.groupBy("side", "level", "key").agg(F.sum("n").alias("n")).toArrow()
    if len(set(table.column("side").to_pylist())) < 2:
        table = table.slice(0, 0)
    models = spark.sparkContext.broadcast(Models(table))
    calibration = labelled.where(kept_out).mapInArrow(_scores(models), "accepted boolean, score double")
    least = _threshold(calibration)
    scored = parts.drop("url").mapInArrow(
        _scores(models), "page_id long, host string, path string, rule string, ruled string, score double"
    )
    learned = F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score")
