"""Typed target tables and the upsert target."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named, spare_name
from tidepoint.functions.timefn import ns_to_timestamp, truncate_ns
from tidepoint.operators.upsert import merge_batches
from tidepoint.points import Mapping, PointsSchema
from tidepoint.sinks.files import SharedFiles

MS = 1_000_000
DAY_NS = 86_400 * 1_000_000_000

# Mapping type names and the column type each one creates.
TABLE_TYPES = {
    "float": "double",
    "float64": "double",
    "double": "double",
    "float32": "float",
    "int": "bigint",
    "int32": "bigint",
    "int64": "bigint",
    "bigint": "bigint",
    "uint": "bigint",
    "uint32": "bigint",
    "uint64": "bigint",
    "string": "string",
    "varchar": "string",
    "text": "string",
    "bool": "boolean",
    "boolean": "boolean",
    "datetime": "timestamp",
    "time": "timestamp",
}
# Where super-tables differ from plain tables.
SUPER_TABLE_TYPES = {
    **TABLE_TYPES,
    "float": "float",
    "float64": "float",
    "int": "int",
    "int32": "int",
}


def table_type(data_type: str, super_table: bool = False) -> str:
    names = SUPER_TABLE_TYPES if super_table else TABLE_TYPES
    return names.get(data_type.lower(), "string")


def typed_rows(
    points: DataFrame, schema: PointsSchema, mapping: Mapping, super_table: bool = False
) -> DataFrame:
    """Mapped points in the column types of the target; time at ms as ``_migration_time``."""
    types = {f.name: table_type(f.data_type, super_table) for f in mapping.fields}
    columns = [named(t).cast("string").alias(t) for t in schema.tags]
    for name in schema.fields:
        columns.append(_typed(points, name, types.get(name)).alias(name))
    time = ns_to_timestamp(truncate_ns(F.col(schema.time_col), MS))
    return points.select(*columns, time.alias("_migration_time"))


def _typed(points: DataFrame, name: str, type_name: str | None) -> Column:
    column = named(name)
    if type_name is None:
        return column
    if type_name == "timestamp" and isinstance(points.schema[name].dataType, T.LongType):
        return ns_to_timestamp(column)
    fitted = column.try_cast(type_name)
    lost = column.isNotNull() & fitted.isNull()
    message = F.concat(F.lit(f"{name} does not fit {type_name}: "), column.cast("string"))
    return F.when(lost, F.raise_error(message)).otherwise(fitted)


def save_typed_table(rows: DataFrame, table: str, path: str | None = None) -> None:
    """Create the table on first use, at ``path`` if given, and append afterwards.

    Columns the table does not have yet are added to it, columns the rows lack are null. A
    column of another type is refused. Appending again repeats the rows; a target that must
    bear repeated loads is an :class:`UpsertTable` of the same typed rows.
    """
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        (rows.write.option("path", path) if path else rows.write).saveAsTable(table)
        return
    known = {f.name: f.dataType for f in spark.table(table).schema}
    found = {f.name: f.dataType for f in rows.schema}
    for name in known.keys() & found.keys():
        if known[name] != found[name]:
            raise ValueError(
                f"{name} is {known[name].simpleString()} in {table},"
                f" not {found[name].simpleString()}"
            )
    new = [f for f in rows.schema if f.name not in known]
    if new:
        listed = ", ".join(
            "`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in new
        )
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
        spark.catalog.refreshTable(table)
    columns = [
        named(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    rows.select(*columns).write.insertInto(table)


def upsert_rows(points: DataFrame, schema: PointsSchema, sequence: Sequence[str]) -> DataFrame:
    """Points as upsert rows: key time cut to ms, a tag wins over a field of its name."""
    fields = [f for f in schema.fields if f not in schema.tags]
    key_time = truncate_ns(F.col(schema.time_col), MS).alias("key_time_ns")
    extra = [s for s in sequence if s not in schema.tags and s not in fields]
    return points.select(
        key_time,
        *[named(t) for t in schema.tags],
        *[named(f) for f in fields],
        *[named(s) for s in extra],
    )


def flat_rows(points: DataFrame, schema: PointsSchema, sequence: Sequence[str]) -> DataFrame:
    """Points as rows of a flat table: time and fields, no tags.

    Rows are upserted on ``time_ns``, so loading the same points again adds nothing. Points
    with tags are of several series, of which only one could stay per time; they are refused.
    """
    if schema.tags:
        raise ValueError(f"a flat table has no tags, so these would merge: {schema.tags}")
    extra = [s for s in sequence if s not in schema.fields]
    return points.select(
        F.col(schema.time_col).alias("time_ns"),
        *[named(f) for f in schema.fields],
        *[named(s) for s in extra],
    )


WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*WHOLE_NUMBERS, T.FloatType, T.DoubleType)


def wider_type(name: str, one: T.DataType, two: T.DataType) -> T.DataType:
    """The type for a column that comes in two: whole numbers widen, with fractions to double."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, WHOLE_NUMBERS) and isinstance(two, WHOLE_NUMBERS):
        return max(one, two, key=lambda t: WHOLE_NUMBERS.index(type(t)))
    if isinstance(one, NUMBERS) and isinstance(two, NUMBERS):
        return T.DoubleType()
    raise ValueError(f"{name} is {one.simpleString()} and cannot take {two.simpleString()}")


def slice_of(time_ns: Column, width_ns: int) -> Column:
    """Storage slice of a time, named by its start in ns; rows without a time share one."""
    return F.coalesce(truncate_ns(time_ns, width_ns).cast("string"), F.lit("none"))


# Versions a reader may still be on; older ones are removed after an upsert. 0 keeps all.
KEEP_VERSIONS = 10


class UpsertTable:
    """A Parquet table with insert-or-update on a key.

    Parquet has no MERGE and cannot overwrite what is being read, so an upsert writes new
    files for the time slices it touches and then adds a manifest that names, per slice,
    the folder that holds it. Readers follow the newest manifest; untouched slices are
    neither read nor rewritten. A run that dies before the manifest leaves the table as it
    was, and repeating an upsert gives the same table.

    One writer at a time; readers are not disturbed by it. ``slice_ns`` should make a slice a
    few GB: days for dense data, longer for sparse.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence: Sequence[str],
        slice_time: str | None = None,
        slice_ns: int = DAY_NS,
        keep_versions: int = KEEP_VERSIONS,
    ):
        self.keep_versions = keep_versions
        self.slice_ns = slice_ns if slice_time else 0
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sequence, self.slice_time = list(keys), list(sequence), slice_time
        self._files = SharedFiles(spark)

    def _versions(self) -> list[int]:
        names = self._files.names(f"{self.path}/manifest")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _manifest(self, version: int | None = None) -> dict | None:
        """``{version, slice_ns, schema, slices: {slice: version}, written: {version: …}}``.

        ``written`` has the schema of each data version, the name of its slice folders, and
        the same of those slices that were merged with rows they held. It grows with the number of slices of the table, not with its rows.
        """
        versions = self._versions()
        if not versions:
            return None
        name = f"{max(versions) if version is None else version:010d}.json"
        manifest = json.loads(self._files.read(f"{self.path}/manifest/{name}"))
        if manifest["slice_ns"] != self.slice_ns:
            raise ValueError(f"{self.path} is sliced by {manifest['slice_ns']} ns")
        return manifest

    def version(self) -> int:
        return max(self._versions(), default=0)

    def current(self) -> DataFrame | None:
        """The table now, or None when nothing has been written."""
        manifest = self._manifest()
        return self._read(manifest, manifest["slices"]) if manifest else None

    def between(self, start_ns: int, end_ns: int) -> DataFrame | None:
        """Rows with ``start <= time < end``; slices outside are not even listed."""
        manifest = self._manifest()
        if manifest is None or not self.slice_time:
            raise ValueError("the table is empty or not sliced by time")
        inside = [
            s
            for s in manifest["slices"]
            if s != "none" and int(s) < end_ns and int(s) + self.slice_ns > start_ns
        ]
        if not inside:
            return None
        time = F.col(self.slice_time)
        return self._read(manifest, inside).where((time >= start_ns) & (time < end_ns))

    def _read(self, manifest: dict, slices: Sequence[str]) -> DataFrame:
        """Slices in the types of the table now; each is read in the types it was written in."""
        schema = T.StructType.fromJson(manifest["schema"])
        paths: dict[str, list[str]] = {}
        for s in slices:
            version = manifest["slices"][s]
            place, written = f"v={version}", manifest["written"][str(version)]
            if s in written["merged"]:
                place, written = f"v={version}/merged", written["merged"][s]
            paths.setdefault(json.dumps(written["schema"]), []).append(
                f"{self.path}/data/{place}/{written['folder']}={s}"
            )
        parts = []
        for stored, found in paths.items():
            own = T.StructType.fromJson(json.loads(stored))
            have = set(own.names)
            part = self.spark.read.schema(own).parquet(*found)
            columns = [
                (named(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema
            ]
            parts.append(part.select(*columns))
        return reduce(DataFrame.unionByName, parts)

    def _slice(self) -> Column:
        if not self.slice_time:
            return F.lit("all")
        return slice_of(F.col(self.slice_time), self.slice_ns)

    def _placed(self, rows: DataFrame, folder: str) -> DataFrame:
        """Adaptive execution splits a large slice over several files and merges small ones,
        in place of one file per task and slice."""
        return rows.hint("rebalance", folder) if self.slice_time else rows

    def _write(self, rows: DataFrame, path: str) -> tuple[str, list[str]]:
        """Write ``rows`` by slice; the folder name used, and the slices found written."""
        folder = spare_name(rows.columns, "slice")
        rows = rows.withColumn(folder, self._slice())
        self._placed(rows, folder).write.mode("overwrite").partitionBy(folder).parquet(path)
        prefix = f"{folder}="
        found = self._files.names(path)
        return folder, [n.removeprefix(prefix) for n in found if n.startswith(prefix)]

    def upsert(self, incoming: DataFrame) -> int:
        """Merge ``incoming`` and return the version that holds it.

        ``incoming`` is evaluated once, written with one row per key. Which slices it touches
        is read off there, so a source that grows meanwhile loses nothing. A slice that is new
        to the table stays as it was written; only those that hold rows already are merged
        with them and written again.
        """
        manifest = self._manifest()
        version = (manifest["version"] if manifest else 0) + 1
        schema = self._schema_with(manifest, incoming.schema)
        own = [f for f in schema if f.name in incoming.columns]
        typed = incoming.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in own])
        fresh = merge_batches(None, typed, self.keys, self.sequence)
        place = f"{self.path}/data/v={version}"
        folder, touched = self._write(fresh, place)
        if not touched:
            self._files.remove(place)
            return version - 1
        slices = manifest["slices"] if manifest else {}
        written = dict(manifest["written"]) if manifest else {}
        own_slices = {"schema": fresh.schema.jsonValue(), "folder": folder, "merged": {}}
        affected = sorted(set(touched) & slices.keys())
        if affected:
            existing = self._read(manifest | {"schema": schema.jsonValue()}, affected)
            added = self.spark.read.schema(fresh.schema).parquet(
                *[f"{place}/{folder}={s}" for s in affected]
            )
            merged = merge_batches(existing, added, self.keys, self.sequence)
            both, _ = self._write(merged, f"{place}/merged")
            as_merged = {"schema": merged.schema.jsonValue(), "folder": both}
            own_slices["merged"] = {s: as_merged for s in affected}
        slices = {**slices, **{s: version for s in touched}}
        written[str(version)] = own_slices
        used = {str(v) for v in slices.values()}
        self._files.create(
            f"{self.path}/manifest/{version:010d}.json",
            json.dumps(
                {
                    "version": version,
                    "slice_ns": self.slice_ns,
                    "schema": schema.jsonValue(),
                    "slices": slices,
                    "written": {v: w for v, w in written.items() if v in used},
                }
            ),
        )
        if self.keep_versions:
            self.expire(self.keep_versions)
        return version

    @staticmethod
    def _schema_with(manifest: dict | None, incoming: T.StructType) -> T.StructType:
        """Known columns first, in the wider of both types, then new ones.

        A column once written is never lost. Types that do not go together are refused
        before anything is written.
        """
        known = T.StructType.fromJson(manifest["schema"]).fields if manifest else []
        types = {f.name: f.dataType for f in incoming}
        names = {f.name for f in known}
        kept = [
            T.StructField(f.name, wider_type(f.name, f.dataType, types.get(f.name, f.dataType)))
            for f in known
        ]
        new = [T.StructField(f.name, f.dataType) for f in incoming if f.name not in names]
        return T.StructType([*kept, *new])

    def expire(self, keep: int = 10) -> None:
        """Remove manifests older than the last ``keep`` and data only those named."""
        versions = sorted(self._versions())
        kept = versions[-max(keep, 1) :]
        if kept == versions:
            return
        used = {v for version in kept for v in self._manifest(version)["slices"].values()}
        for version in versions[: -len(kept)]:
            self._files.remove(f"{self.path}/manifest/{version:010d}.json")
        for name in self._files.names(f"{self.path}/data"):
            number = int(name.removeprefix("v="))
            if number not in used and number <= versions[-1]:
                self._files.remove(f"{self.path}/data/{name}")
