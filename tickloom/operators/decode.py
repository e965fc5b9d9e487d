"""Wire text to typed bars, with unreadable records set aside instead of dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import parse_instant
from tickloom.schema import BAR_FIELDS, VALUE_FIELDS, WIRE_SCHEMA

_BROKEN, _INSTANT, _NOTED = "_broken", "_instant", "_noted"
_PARSED = T.StructType(WIRE_SCHEMA.fields + [T.StructField(_BROKEN, T.StringType())])


def decode_bars(
    records: DataFrame, text: str = "value", arrival: str | None = None
) -> DataFrame:
    """Parse the JSON in ``text`` into bar columns, ``ingest_ts``, ``reject_reason``.

    Works on batch and streaming frames and keeps every row; the reason is null
    for a good bar. Other columns, the text among them, are carried along. The
    ingest time is the one noted in the record, else the column ``arrival``.

    The parsed record goes through a one-element generator on purpose: later filters
    stop there. As a projection, Catalyst would copy the parse into each filter pushed
    below it and read every text several times. Instants are parsed inside as well.
    """
    records = records.withColumn(text, F.col(text).cast("string"))
    parsed = F.from_json(
        F.col(text), _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    )
    rows = records.select("*", F.inline(F.transform(F.array(parsed), _typed)))
    ingested = F.coalesce(_NOTED, F.col(arrival)) if arrival else F.col(_NOTED)
    return rows.withColumns(
        {"reject_reason": _reason(text), "date": F.col(_INSTANT), "ingest_ts": ingested}
    ).drop(_BROKEN, _INSTANT, _NOTED)


def _typed(record: Column) -> Column:
    """The fields of a parsed record, and its two dates as instants."""
    return F.struct(
        *[record[name].alias(name) for name in _PARSED.names],
        parse_instant(record["date"]).alias(_INSTANT),
        parse_instant(record["ingest_ts"]).alias(_NOTED),
    )


def _reason(text: str) -> Column:
    nothing_read = F.col("stock").isNull() & F.col("date").isNull()
    return (
        F.when(F.col(text).isNull(), "null")
        .when(F.trim(F.col(text)) == "", "empty")
        .when((F.col(_BROKEN).isNotNull() & nothing_read) | _goes_on(text), "malformed")
        .when(F.col(_BROKEN).isNotNull(), "bad field")
        .when(F.trim(F.coalesce("stock", F.lit(""))) == "", "no stock")
        .when(F.col("stock").rlike(r"^\s*[{\[]"), "bad stock")
        .when(F.col("date").isNull(), "no date")
        .when(F.col(_INSTANT).isNull(), "bad date")
    )


def _goes_on(text: str) -> Column:
    """Whether anything follows the record in its text, which the parser passes over.

    A text with one pair of braces, at its ends, is a record and no more. Others are
    looked at with their strings blanked; only where that leaves more than one pair are
    the elements counted that the text makes up in an array.
    """
    whole = F.col(text)
    # The first closing brace is the last character, and no second one opens.
    simple = (F.instr(whole, "}") == F.length(whole)) & whole.startswith("{") & (F.locate("{", whole, 2) == 0)
    outline = F.regexp_replace(F.col(text), r'"(?:\\.|[^"\\])*"', '""')
    plain = F.regexp_replace(outline, "[+-]?(?:NaN|INF|Infinity)", "0")
    alone = F.json_array_length(F.concat(F.lit("["), plain, F.lit("]"))) == 1
    return F.when(simple, False).when(outline.rlike(r"^\s*\{[^{}]*\}\s*$"), False).otherwise(~F.coalesce(alone, F.lit(False)))


def accepted(decoded: DataFrame, *keep: str) -> DataFrame:
    """The readable bars of :func:`decode_bars`, with columns ``keep`` if asked."""
    return decoded.where(F.col("reject_reason").isNull()).select(*BAR_FIELDS, *keep)


def rejected(decoded: DataFrame, text: str = "value", *keep: str) -> DataFrame:
    """The dead letters of :func:`decode_bars`: raw text and why it was refused."""
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        F.col(text), "reject_reason", *keep
    )


def typed_bars(frame: DataFrame, *keep: str) -> DataFrame:
    """Cast any frame that has the bar columns to the canonical types."""
    return frame.select(
        F.col("stock").cast("string"),
        F.col("date").cast("timestamp"),
        *[F.col(name).cast("double") for name in VALUE_FIELDS],
        *keep,
    )
