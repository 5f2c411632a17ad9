"""Columns by name, whatever characters the name has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str, side: str | None = None) -> Column:
    """Column ``name``, of the DataFrame alias ``side`` if given."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{side}.{quoted}" if side else quoted)


def spare_name(columns: Iterable[str], base: str) -> str:
    """A name for a helper column that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base
