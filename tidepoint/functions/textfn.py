"""Text of values: number text and line-protocol escapes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# As many fraction digits as the formatter has: it prints the shortest digits that read back
# as the same value, so a pattern this long cuts nothing off.
_ALL_DIGITS = "0." + "#" * 340


def plain_decimal(x: Column, kind: T.DataType | None = None) -> Column:
    """A float as plain decimal text, never with an exponent: 85, 0.1, 10000000."""
    if isinstance(kind, T.FloatType):
        # By way of text, as widening 99.9 alone would show the digits of the double.
        x = x.cast("string").cast("double")
    infinity = float("inf")
    return (
        F.when(x == F.lit(infinity), "+Inf")
        .when(x == F.lit(-infinity), "-Inf")
        .otherwise(F.call_function("format_number", x, F.lit(_ALL_DIGITS)))
    )


def escape_key_text(name: str) -> str:
    """Driver-side escape of a column name: comma, equals sign and space get a backslash."""
    return re.sub(r"([,= ])", r"\\\1", name)


def escape_tag(c: Column) -> Column:
    return F.regexp_replace(c, "([,= ])", r"\\$1")


def escape_measurement(c: Column) -> Column:
    """Like a tag but an equals sign is legal in a measurement name."""
    return F.regexp_replace(c, "([, ])", r"\\$1")


def escape_string(c: Column) -> Column:
    """Backslash first, then quote, so that escapes are not escaped again."""
    slashed = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(slashed, F.lit('"'), F.lit('\\"'))


def field_text(c: Column, kind: T.DataType) -> Column:
    """Line-protocol text of a field value, by column type."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return plain_decimal(c, kind)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.concat(c.cast("string"), F.lit("i"))
    if isinstance(kind, T.StringType):
        return F.concat(F.lit('"'), escape_string(c), F.lit('"'))
    return c.cast("string")
