"""Last write wins per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.columns import named, spare_name


def last_wins(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row per key, the one with the highest ``sequence``; null keys compare as equal.

    An aggregate and not a window: each task first reduces its own rows to one per key, so
    a key that holds most of the rows costs its final task one row per map task. Rows equal
    in ``sequence`` are settled by their values, so the result never depends on row order.
    """
    values = [c for c in df.columns if c not in keys]
    ranked = [*sequence, *[v for v in values if v not in sequence]]
    helper = spare_name(df.columns, "_newest")
    newest = F.max(F.struct(*[named(c) for c in ranked])).alias(helper)
    return (
        df.groupBy(*[named(k) for k in keys])
        .agg(newest)
        .select(
            *[
                named(c) if c in keys else F.col(helper).getField(c).alias(c)
                for c in df.columns
            ]
        )
    )


def merge_batches(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
) -> DataFrame:
    """The table after an insert-or-update of ``incoming``; columns are the union of both."""
    rows = incoming
    if existing is not None:
        rows = existing.unionByName(incoming, allowMissingColumns=True)
    return last_wins(rows, keys, sequence)
