"""The point model: which columns of a DataFrame are tags, fields and time.

A points DataFrame is wide: ``measurement STRING``, one STRING column per tag, one typed
column per field and ``time_ns BIGINT`` (UTC nanoseconds). A null field or tag is absent;
a null time means the point has no timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named
from tidepoint.functions.timefn import to_time_ns

# Limits and defaults of a run.
MIN_BATCH_SIZE, MAX_BATCH_SIZE, DEFAULT_BATCH_SIZE = 1, 1_000_000, 10_000
MIN_SERIES_PER_QUERY, MAX_SERIES_PER_QUERY, DEFAULT_SERIES_PER_QUERY = 1, 1000, 100
HOUR_NS = 3_600 * 1_000_000_000
MIN_WINDOW_NS, MAX_WINDOW_NS, DEFAULT_WINDOW_NS = HOUR_NS, 720 * HOUR_NS, 168 * HOUR_NS


@dataclass(frozen=True)
class PointsSchema:
    tags: tuple[str, ...]
    fields: tuple[str, ...]
    measurement_col: str = "measurement"
    time_col: str = "time_ns"
    id_col: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "tags", tuple(sorted(self.tags)))
        object.__setattr__(self, "fields", tuple(sorted(self.fields)))

    @property
    def columns(self) -> list[str]:
        extra = [self.id_col] if self.id_col and self.id_col not in self.fields else []
        return [self.measurement_col, *self.tags, *self.fields, self.time_col, *extra]

    @property
    def series_columns(self) -> list[str]:
        return [self.measurement_col, *self.tags]


@dataclass(frozen=True)
class FieldMap:
    """Take field ``source``, cast it to ``data_type`` and call it ``target``."""

    source: str
    target: str = ""
    data_type: str = ""

    @property
    def name(self) -> str:
        return self.target or self.source


@dataclass(frozen=True)
class TagMap:
    source: str
    target: str = ""

    @property
    def name(self) -> str:
        return self.target or self.source


@dataclass(frozen=True)
class Mapping:
    """What one source table turns into. ``source_table`` of ``""`` or ``"*"`` is any table."""

    source_table: str = "*"
    target_measurement: str = ""
    tags: tuple[TagMap, ...] = ()
    fields: tuple[FieldMap, ...] = ()
    tag_filters: dict[str, Sequence[str]] = field(default_factory=dict)
    start: str | None = None
    end: str | None = None
    window_ns: int = DEFAULT_WINDOW_NS
    subtable_pattern: str = ""
    timestamp_column: str | None = None

    @property
    def is_wildcard(self) -> bool:
        return self.source_table in ("", "*")

    def validate(self) -> "Mapping":
        """Raise ``ValueError`` where two targets would share a name or a limit is broken."""
        field_names = [f.name for f in self.fields if f.source]
        tag_names = [t.name for t in self.tags if t.source]
        for kind, names in (("field", field_names), ("tag", tag_names)):
            repeated = sorted({n for n in names if names.count(n) > 1})
            if repeated:
                raise ValueError(f"duplicate {kind} target names: {repeated}")
        clash = sorted(set(field_names) & set(tag_names))
        if clash:
            raise ValueError(f"field and tag targets share names: {clash}")
        check_window(self.window_ns)
        return self


def check_batch_size(size: int) -> int:
    size = size or DEFAULT_BATCH_SIZE
    if not MIN_BATCH_SIZE <= size <= MAX_BATCH_SIZE:
        raise ValueError(f"batch size must be in {MIN_BATCH_SIZE}..{MAX_BATCH_SIZE}, got {size}")
    return size


def check_window(width_ns: int) -> int:
    width_ns = width_ns or DEFAULT_WINDOW_NS
    if not MIN_WINDOW_NS <= width_ns <= MAX_WINDOW_NS:
        raise ValueError(f"window must be 1h..720h, got {width_ns / HOUR_NS}h")
    return width_ns


def check_series_per_query(n: int) -> int:
    n = n or DEFAULT_SERIES_PER_QUERY
    if not MIN_SERIES_PER_QUERY <= n <= MAX_SERIES_PER_QUERY:
        raise ValueError(
            f"series per query must be in {MIN_SERIES_PER_QUERY}..{MAX_SERIES_PER_QUERY}, got {n}"
        )
    return n


def field_kind(data_type: T.DataType) -> str:
    """Sort a Spark type into the value kinds a field can hold."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "float"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(data_type, T.BinaryType):
        return "binary"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    raise ValueError(f"{data_type.simpleString()} cannot be a field value")


def widest_kind(kinds: Sequence[str]) -> str:
    """One kind for a field seen with several: int and float give float, a mix gives string."""
    found = {k for k in kinds if k}
    if len(found) == 1:
        return found.pop()
    if found <= {"int", "float", "decimal"}:
        return "float"
    return "string"


def infer_roles(df: DataFrame, time_column: str, id_column: str | None = None) -> PointsSchema:
    """Text columns are tags and the rest fields, the rule used when no roles are given."""
    tags, fields = [], []
    for column in df.schema.fields:
        if column.name in (time_column, "measurement"):
            continue
        kind = field_kind(column.dataType)
        (tags if kind == "string" and column.name != id_column else fields).append(column.name)
    return PointsSchema(tuple(tags), tuple(fields), id_col=id_column)


def normalised_field(df: DataFrame, name: str) -> Column:
    """Widen a field to the type points use for its kind."""
    kind = field_kind(df.schema[name].dataType)
    column = named(name)
    if kind in ("float", "decimal"):
        return column.cast("double")
    if kind == "int":
        return column.cast("bigint")
    if kind == "binary":
        return F.decode(column, "UTF-8")
    if kind == "time":
        return to_time_ns(df, name)
    return column


def tag_text(df: DataFrame, name: str) -> Column:
    """A tag as text, absent when empty; only text can be empty."""
    column = named(name)
    if field_kind(df.schema[name].dataType) == "string":
        return F.when(column != "", column)
    return column.cast("string")


def to_points(
    df: DataFrame,
    schema: PointsSchema,
    time_column: str | None,
    measurement: str | Column,
) -> DataFrame:
    """Project source rows to the wide points form. A pure ``select``: pushes down and prunes."""
    name = F.lit(measurement) if isinstance(measurement, str) else measurement
    time = F.lit(None).cast("bigint") if time_column is None else to_time_ns(df, time_column)
    columns = [name.alias(schema.measurement_col)]
    columns += [tag_text(df, t).alias(t) for t in schema.tags]
    columns += [normalised_field(df, f).alias(f) for f in schema.fields]
    columns.append(time.alias(schema.time_col))
    if schema.id_col and schema.id_col not in schema.fields:
        columns.append(named(schema.id_col).cast("bigint").alias(schema.id_col))
    return df.select(*columns)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
