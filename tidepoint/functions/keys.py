"""Series keys: ``measurement,tag1=v1,tag2=v2`` with tags in name order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepoint.functions.columns import named


def tag_is_set(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def series_key(measurement: Column, tags: Sequence[str]) -> Column:
    """Build the key from tag columns; a null or empty tag is left out."""
    parts = [
        F.when(tag_is_set(named(t)), F.concat(F.lit(f"{t}="), named(t)))
        for t in sorted(tags)
    ]
    return F.concat_ws(",", measurement, *parts)


def series_pairs(key: Column) -> Column:
    """Tags of a key as ``array<struct<name, value>>``.

    The first part is the measurement. A part splits at its first equals sign, a part
    without one is skipped, and of repeated names the last one holds.
    """
    parts = F.split(key, ",")
    tag_parts = F.filter(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: p.contains("="),
    )
    pairs = F.transform(
        tag_parts,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("name"),
            F.substr(p, F.instr(p, "=") + 1).alias("value"),
        ),
    )
    return F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["name"] == p["name"]
        ),
    )


def series_tags(key: Column) -> Column:
    """Tags of a key as ``map<string, string>``."""
    return F.map_from_entries(series_pairs(key))


def series_measurement(key: Column) -> Column:
    return F.substring_index(key, ",", 1)
