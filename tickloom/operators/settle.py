"""The last row of every key under an order of any columns, by hash aggregates only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import run_dir

#: Types of fixed width, of which a maximum is kept in place by a hash aggregate.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Two digests of a row's values; together they break ties between different rows.
DIGESTS = ("digest_1", "digest_2")


def settle_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, for every key, the row that comes last in ``order``, columns of any type.

    Maxima are taken in stages: of the first column, then among the rows that tie in it of
    the next. Each stage is a hash aggregate that combines before the shuffle, and a semi-join
    on the keys and the column together, so that a hot key is spread by the column's
    values. Only rows that tie so far go on. A column without a fixed width, such as text,
    is compared by its rank among the distinct values still in play, which a range sort gives.

    Null comes before every value, in keys it is a value; NaN comes last, as Spark sorts it.
    Rows that tie in the whole order are settled by a digest of all values: always the same
    one, and one of several equal rows. Columns must be of types that Spark can group by, and
    may have any names. An empty frame gives an empty one.
    """
    columns = rows.columns
    plain = {name: f"c{number}" for number, name in enumerate(columns)}
    keys, order = [plain[name] for name in keys], [plain[name] for name in order]
    numbered = rows.toDF(*plain.values())
    digests = [F.xxhash64(F.lit(seed), *numbered.columns).alias(name) for seed, name in enumerate(DIGESTS)]
    marked = numbered.select("*", *digests)
    stages = [name for name in order if name not in keys] + list(DIGESTS)
    left = _stored(marked.select(*keys, *stages).distinct(), "tuples")
    for name in stages:
        # Written, as the next stage reads it twice and plans would double with every stage.
        left = _stored(_semi(left, _largest(left, keys, name), [*keys, name]), "tied")
    # What is left has one tuple per key; equal rows have one tuple and become one row.
    settled = _semi(marked, left, [*keys, *stages])
    return settled.select(*plain.values()).distinct().toDF(*columns)


def _largest(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The largest value of a column for every key."""
    if isinstance(rows.schema[name].dataType, FIXED_WIDTH):
        return rows.groupBy(*keys).agg(F.max(name).alias(name))
    values = rows.select(*keys, name).distinct()
    # Partitions are ranges in order and ids rise within and over them; null has none.
    ranks = values.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name)
    ranks = _stored(ranks.withColumn("_rank", F.monotonically_increasing_id()), "ranks")
    best = values.join(ranks, name, "left").groupBy(*keys).agg(F.max("_rank").alias("_rank"))
    return best.join(ranks, "_rank", "left").select(*keys, name)


def _semi(rows: DataFrame, kept: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows whose ``names`` are among those of ``kept``, null being equal to null."""
    kept = kept.select(*[F.col(name).alias(f"_kept_{name}") for name in names])

    def same(name: str) -> Column:
        return F.col(name).eqNullSafe(F.col(f"_kept_{name}"))

    return rows.join(kept, reduce(and_, map(same, names)), "left_semi")


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """A written copy in the shared folder: later stages read it, lost executors or not."""
    path = run_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
