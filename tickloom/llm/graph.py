"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.store import removed, written


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _stars(links: DataFrame) -> DataFrame:
    """One union-find sweep over links ``a > b``: hang all on smallest neighbours.

    First each node's larger neighbours move to the node's smallest one, then its
    smaller ones do. Minima combine before the shuffle and come back by a join that
    adaptive execution may split, so a node with very many links stays cheap.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a != b")
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``links (a, b)``: the smallest id reachable.

    Nulls and links of a node with itself link nothing. The sweeps double the reach of
    every node, so their number grows with the logarithm of the longest chain; each
    one's links are written to the shared folder, and only a count and a checksum reach
    the driver. No links: no rows.
    """
    links = links.where("a is not null and b is not null and a != b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(spark, links, "links")
    state = _state(links)
    while state[0]:
        swept = written(spark, _stars(links), "links")
        removed(spark, links)
        links, before, state = swept, state, _state(swept)
        if state == before:
            break
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
