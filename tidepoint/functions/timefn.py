"""Time columns. Nanoseconds since 1970 (UTC) in a BIGINT are the canonical form."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named

# The two text layouts of a time and the cut between epoch seconds and ns.
TIME_PATTERN = (
    r"^\d{4}-\d\d-\d\d(T\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)| \d\d:\d\d:\d\d(\.\d+)?)$"
)
EPOCH_NS_ABOVE = 1e12
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def timestamp_to_ns(ts: Column) -> Column:
    """Null for a time that 64 bits of ns do not reach, before 1677 or after 2262."""
    return F.try_multiply(F.unix_micros(ts.cast("timestamp")), F.lit(1000).cast("bigint"))


def ns_to_timestamp(ns: Column) -> Column:
    """Microsecond timestamp of a ns value, rounding towards the past also before 1970."""
    return F.timestamp_micros(ns_floor_div(ns, 1000))


def ns_floor_div(ns: Column, unit: int) -> Column:
    width = F.lit(unit).cast("bigint")
    return F.call_function("div", ns - F.pmod(ns, width), width)


def time_is_set(ns: Column) -> Column:
    return ns.isNotNull() & (ns != 0)


def ns_to_ms_text(ns: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, digits below the millisecond cut off."""
    return F.date_format(ns_to_timestamp(ns), "yyyy-MM-dd HH:mm:ss.SSS")


def truncate_ns(ns: Column, unit_ns: int) -> Column:
    return ns - F.pmod(ns, F.lit(unit_ns).cast("bigint"))


def parse_time_ns(text: Column) -> Column:
    """Text time to ns with all nine fraction digits; null when no layout fits.

    ``text`` may be any expression: it is evaluated once and bound, as the parser reads it
    in a dozen places. :func:`parse_time_column` spares the binding of a bare column.
    """
    return F.transform(F.array(text), parse_time_column)[0]


def parse_time_column(text: Column) -> Column:
    """:func:`parse_time_ns` of a bare column.

    Spark's own cast reads the time to the microsecond; digits seven to nine, which stand at
    a fixed place, are added. One pattern settles the layout, as the cast alone takes more.
    """
    parsed = (
        F.when(text.endswith("Z"), _cast_ns(text, 1))
        .when(F.substring(text, 11, 1) == " ", _cast_ns(F.concat(text, F.lit("Z")), 1))
        .otherwise(_cast_ns(text, 6))
    )
    return F.when(text.rlike(TIME_PATTERN), parsed)


def _cast_ns(text: Column, zone: int) -> Column:
    """ns of a well-formed time that ends in ``zone`` characters of time zone."""
    body = F.length(text) - zone
    nine = F.when(
        body > 29, F.concat(F.substring(text, 1, 29), F.substring(text, -zone, zone))
    ).otherwise(text)
    digits = F.substring(text, F.lit(27), F.least(body - 26, F.lit(3)))
    tail = F.when(body > 26, F.rpad(digits, 3, "0").try_cast("bigint"))
    whole = F.try_multiply(F.unix_micros(nine.try_cast("timestamp")), F.lit(1000).cast("bigint"))
    return F.try_add(whole, F.coalesce(tail, F.lit(0).cast("bigint")))


def epoch_number_to_ns(value: Column) -> Column:
    """Numbers above 1e12 already are ns, smaller ones are whole seconds."""
    whole = value.try_cast("bigint")
    return F.when(value > F.lit(EPOCH_NS_ABOVE), whole).otherwise(
        F.try_multiply(whole, F.lit(1_000_000_000).cast("bigint"))
    )


def to_time_ns(df: DataFrame, name: str) -> Column:
    """ns of column ``name`` whatever its type; BIGINT is taken as ns with 0 = no time."""
    column, kind = named(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        if zone not in UTC_NAMES:
            raise ValueError(f"times without zone would be read as {zone}: call use_utc first")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return timestamp_to_ns(column)
    if isinstance(kind, T.StringType):
        return parse_time_column(column)
    if isinstance(kind, T.LongType):
        return F.nullif(column, F.lit(0).cast("bigint"))
    return epoch_number_to_ns(column)


def time_faults(df: DataFrame, name: str) -> DataFrame:
    """One row: ``rows``, those ``without_time``, and those ``out_of_range``: a time is given
    but is no ns, because it is too far or, as text, has no known layout."""
    column = named(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        given = column.isNotNull() & (column != "")
    elif isinstance(df.schema[name].dataType, T.LongType):
        given = time_is_set(column)
    else:
        given = column.isNotNull()
    unusable = given & to_time_ns(df, name).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~given).alias("without_time"),
        F.count_if(unusable).alias("out_of_range"),
    )


def parse_instant(value: str | datetime | date | int) -> int:
    """Driver-side: an RFC3339 text, datetime or ns integer to ns."""
    if isinstance(value, bool):
        raise ValueError(f"not a time: {value!r}")
    if isinstance(value, int):
        return value
    fraction_ns = 0
    if isinstance(value, str):
        # datetime stops at microseconds, so the fraction is read apart.
        fraction = re.search(r"\.(\d+)", value)
        if fraction:
            fraction_ns = int(fraction.group(1)[:9].ljust(9, "0"))
            value = value.replace(fraction.group(0), "", 1)
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    delta = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
    seconds = delta.days * 86_400 + delta.seconds
    return (seconds * 1_000_000 + delta.microseconds) * 1000 + fraction_ns


def time_literal(kind: T.DataType, ns: int) -> Column:
    """A literal of the column's own type, so that comparing needs no cast of the column.

    A cast on the column side would keep the predicate from reaching the Parquet reader.
    Columns hold microseconds, so ``ns`` is rounded up: ``ts >= x`` and ``ts < x`` keep their
    meaning.
    """
    if isinstance(kind, T.LongType):
        return F.lit(ns).cast("bigint")
    micros = -(-ns // 1000)
    text = F.lit(_micros_text(micros))
    if isinstance(kind, T.TimestampNTZType):
        return text.cast("timestamp_ntz")
    if isinstance(kind, T.TimestampType):
        return F.concat(text, F.lit("Z")).cast("timestamp")
    if isinstance(kind, T.DateType):
        days = -(-micros // 86_400_000_000)
        return F.lit(_micros_text(days * 86_400_000_000)[:10]).cast("date")
    raise ValueError(f"{kind.simpleString()} is not a time column type")


def _micros_text(micros: int) -> str:
    seconds, rest = divmod(micros, 1_000_000)
    moment = datetime.fromtimestamp(seconds, tz=timezone.utc)
    return f"{moment:%Y-%m-%dT%H:%M:%S}.{rest:06d}"
