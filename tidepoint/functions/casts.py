"""Value casts of a field mapping. A null stays null; a value that does not fit gives zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.textfn import plain_decimal
from tidepoint.points import field_kind

# Accepted spellings of numbers and of true, and the names of the casts.
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_WORD_PATTERN = r"^(?i)([+-]?(inf|infinity)|nan)$"
INT_PATTERN = r"^[+-]?[0-9]+$"
TRUE_WORDS = ("true", "yes", "on", "1")
FLOAT_NAMES = ("float",)
INT_NAMES = ("int", "integer")
STRING_NAMES = ("string",)
BOOL_NAMES = ("bool", "boolean")


def cast_value(c: Column, source: T.DataType, data_type: str) -> Column:
    """Cast ``c`` of Spark type ``source`` to the named type; unknown names change nothing."""
    kind = field_kind(source)
    if kind == "binary":
        c, kind = F.decode(c, "UTF-8"), "string"
    if data_type in FLOAT_NAMES:
        result = to_float(c, kind)
    elif data_type in INT_NAMES:
        result = to_int(c, kind)
    elif data_type in STRING_NAMES:
        result = to_text(c, kind, source)
    elif data_type in BOOL_NAMES:
        result = to_bool(c, kind)
    else:
        return c
    return F.when(c.isNotNull(), result)


def to_float(c: Column, kind: str) -> Column:
    if kind in ("float", "int", "decimal"):
        return c.cast("double")
    if kind == "string":
        parsed = c.try_cast("double")
        finite = c.rlike(FLOAT_PATTERN) & (F.abs(parsed) != F.lit(float("inf")))
        return F.when(finite | c.rlike(FLOAT_WORD_PATTERN), parsed).otherwise(F.lit(0.0))
    return F.lit(0.0)


def to_int(c: Column, kind: str) -> Column:
    zero = F.lit(0).cast("bigint")
    if kind == "int":
        return c.cast("bigint")
    if kind in ("float", "decimal"):
        return F.coalesce(c.try_cast("bigint"), zero)
    if kind == "string":
        return F.coalesce(F.when(c.rlike(INT_PATTERN), c.try_cast("bigint")), zero)
    return zero


def to_text(c: Column, kind: str, source: T.DataType) -> Column:
    if kind == "float":
        return plain_decimal(c, source)
    if kind == "time":
        return F.lit("")
    return c.cast("string")


def to_bool(c: Column, kind: str) -> Column:
    if kind == "bool":
        return c
    if kind == "string":
        return F.lower(c).isin(*TRUE_WORDS)
    if kind in ("int", "float", "decimal"):
        return c != 0
    return F.lit(False)
