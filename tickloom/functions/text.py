"""Text forms of values on the wire: instants, numbers, escaped names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.scalar import column

# The powers of ten at which a number is written without an exponent.
PLAIN_FROM = -4
PLAIN_TO = 15


def iso_utc(date: Column | str) -> Column:
    """ISO-8601 text in UTC, a fraction only where there is one.

    Relies on the session time zone being UTC (see ``pin_runtime``).
    """
    return F.concat(F.translate(column(date).cast("string"), " ", "T"), F.lit("Z"))


def number_text(number: Column | str) -> Column:
    """A double as ``12345678.0``, ``0.0001`` or ``1e+16``.

    Spark's own cast turns to exponents from 1e7 up and below 1e-3, which is
    where trading volumes live.
    """
    return without_exponent(column(number).cast("double").cast("string"))


def without_exponent(text: Column | str) -> Column:
    """Rewrite the text of a double so that exponents appear only at the extremes.

    Text that has none stays as it is; the rest goes through a decimal wide enough
    for every digit a double carries in the plain range.
    """
    text = column(text)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.format_string("%02d", F.abs(exponent)),
    )
    return (
        F.when(~text.contains("E"), text)
        .when(~exponent.between(PLAIN_FROM, PLAIN_TO), scientific)
        .when(digits.endswith("."), F.concat(digits, F.lit("0")))
        .otherwise(digits)
    )


def is_finite(number: Column | str) -> Column:
    """True for a number a point can carry: neither null nor NaN nor infinite."""
    number = column(number).cast("double")
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))


def escape_name(text: Column | str) -> Column:
    """Escape comma, equals sign, space, backslash and line ends, as in tags and keys."""
    return _one_line(F.regexp_replace(column(text), r"([,= \\])", r"\\$1"))


def escape_measurement(text: Column | str) -> Column:
    """Escape comma, space, backslash and line ends, as in measurement names."""
    return _one_line(F.regexp_replace(column(text), r"([, \\])", r"\\$1"))


def _one_line(text: Column) -> Column:
    """Line ends spelled out: a point is one line, whatever its names hold."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
