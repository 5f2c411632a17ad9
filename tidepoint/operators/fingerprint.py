"""Comparing a source and its target by fingerprints, and row by row only where they differ.

A fingerprint is a count and the sums of two 64-bit hashes of the rows, in halves, per window
and bucket of keys. Sums do not depend on the order of rows, combine before they move, and
differ when a row is lost, added, changed or repeated. So what is shuffled for a whole table
is one row per window and bucket; rows move only in windows that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named, spare_name
from tidepoint.operators.reconcile import reconcile
from tidepoint.operators.windows import window_start_of
from tidepoint.session import small_or_pinned

BUCKETS = 64
_SUMS = ("low_a", "high_a", "low_b", "high_b")


def _hashes(rows: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Both hashes of a row in halves of 32 bits, so that sums stay in a BIGINT for two
    billion rows of a window and bucket. Nulls count by their place; both zeros are one."""
    parts = []
    for name in columns:
        column = named(name)
        if isinstance(rows.schema[name].dataType, (T.DoubleType, T.FloatType)):
            column = column + F.lit(0.0)
        parts += [column.isNull(), column]
    a, b = F.xxhash64(*parts), F.xxhash64(F.lit("b"), *parts)
    low = F.lit(0xFFFFFFFF).cast("bigint")
    halves = (a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32))
    return dict(zip(_SUMS, halves))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(buckets)).cast("int")


def window_fingerprints(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], window: Column, buckets: int = BUCKETS
) -> DataFrame:
    """``window_start, bucket, rows`` and the sums of hashes."""
    hashes = _hashes(rows, [*keys, *values])
    return rows.groupBy(
        window.alias("window_start"), key_bucket(keys, buckets).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(n) for n, h in hashes.items()])


def differing_windows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Windows and buckets whose fingerprints are not the same on both sides."""
    sides = [
        side.select(
            "window_start", "bucket", F.lit(sign).alias("sign"),
            *[F.col(c) for c in ("rows", *_SUMS)],
        )
        for side, sign in ((source, 1), (target, -1))
    ]
    summed = sides[0].unionByName(sides[1]).groupBy("window_start", "bucket").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("rows", *_SUMS)],
        F.sum(F.when(F.col("sign") > 0, F.col("rows")).otherwise(0)).alias("source_rows"),
        F.sum(F.when(F.col("sign") < 0, F.col("rows")).otherwise(0)).alias("target_rows"),
    )
    equal = F.lit(True)
    for c in ("rows", *_SUMS):
        equal &= F.col(c) == 0
    return summed.where(~equal).select("window_start", "bucket", "source_rows", "target_rows")


def _as_typed(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target's columns in the source's types, as hashes depend on them."""
    return target.select(
        *[named(c).cast(source.schema[c].dataType).alias(c) for c in columns]
    )


def reconcile_windows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    time: str,
    width_ns: int,
    origin_ns: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys that are not the same on both sides, per window of ``time``.

    ``window_start``, the keys, ``source_rows, target_rows`` and ``status``: ``changed``,
    ``missing`` or ``extra``. Both sides are read once for the fingerprints; windows that
    agree are not read into a join. Rows without a time are a window of their own.
    """
    columns = list(dict.fromkeys([*keys, *values, time]))
    window = window_start_of(F.col(time), width_ns, origin_ns)
    target = _as_typed(target, source, columns)
    values = [c for c in columns if c not in keys]
    differing = small_or_pinned(
        differing_windows(
            window_fingerprints(source, keys, values, window, buckets),
            window_fingerprints(target, keys, values, window, buckets),
        ).select("window_start", "bucket")
    )
    place, bucket = (spare_name(columns, c) for c in ("window_start", "_bucket"))

    def open_rows(rows: DataFrame) -> DataFrame:
        placed = rows.select(
            *columns, window.alias(place), key_bucket(keys, buckets).alias(bucket)
        ).alias("r")
        there = differing.alias("d")
        on = F.col(f"r.{place}").eqNullSafe(F.col("d.window_start")) & (
            F.col(f"r.{bucket}") == F.col("d.bucket")
        )
        return placed.join(there, on, "left_semi").drop(bucket)

    compared = reconcile(open_rows(source), open_rows(target), [place, *keys], values)
    return compared.where(F.col("status") != "same")
