"""Web archives: a deterministic sharded writer and a reader.

The writer cuts the keys, in order, into shards of about ``shard_bytes`` by exact running sums
of payload bytes, so that the same table gives the same files whatever its partitioning, and
a shard is no larger where keys are far apart, repeat or are null. Each shard
is sorted by key and written by one task, which closes a file when its compressed size
reaches ``roll_bytes``. Headers, record ids and digests are made anew from the payload.
Tasks write under temporary names and report them; when all tasks have reported, a second
job renames the reported files, and a manifest is written last. Files of failed or repeated
task attempts are never in a report, and are removed. An archive without its manifest is
not complete.

Archives are written through Arrow's file systems (local, S3, GCS, HDFS) from the URI of the
folder. A payload that occurs again is written once: of equal payloads of at least
``revisit_bytes`` bytes, the one with the largest key becomes the response and the others
revisit it.

Defined cases: a null payload is empty; a null or odd URL becomes ``urn:page:<id>`` or is
percent-encoded; a null key gets a record as well and orders first; rows that repeat key and
payload are each written, and each is a response if its key is the group's largest; an empty
table gives an archive without files.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.session import pin

SHARD_BYTES = 16 << 20
ROLL_BYTES = 8 << 20
REVISIT_BYTES = 1000
MAX_SHARDS = 100_000  # bounds sent to every task, some 50 bytes each
CRAWL_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard int, seq int, temp string, name string, records long, bytes long, sha256 string"
READ_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, file string"
)


def _file_system(uri: str):
    return pafs.FileSystem.from_uri(uri)


def page_rows(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")
    ).select(
        "*",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )


def revisits(rows: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, payload_digest, refers_to, payload_bytes`` of the rows that are revisits.

    Only ids and digests move. Groups are aggregated first; the join back to their rows is
    spread by adaptive execution.
    """
    narrow = rows.where(F.col("payload_bytes") >= revisit_bytes).select(
        "page_id", "payload_bytes", "payload_digest"
    )
    latest = (
        narrow.groupBy("payload_bytes", "payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    older = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return narrow.join(latest, ["payload_bytes", "payload_digest"]).where(older)


def _by_key() -> tuple[Column, ...]:
    return F.col("page_id").asc_nulls_first(), F.col("payload_digest").asc()


def shard_bounds(
    rows: DataFrame, shard_bytes: int = SHARD_BYTES, most: int = MAX_SHARDS
) -> list[tuple[int | None, str]]:
    """The first key, ``page_id`` and digest, of every shard, in order.

    Bytes are summed in the order of the keys over range partitioned rows without payloads:
    each task sums its own, a sum per task is collected, and a second pass reports the keys at
    which a shard begins. So a shard holds about ``shard_bytes`` whatever the keys are, and the
    bounds do not depend on the partitioning. There are at most ``most`` shards; above that
    many times ``shard_bytes`` they become larger.
    """
    narrow = rows.select("page_id", "payload_digest", (F.col("payload_bytes") + 1).alias("n"))
    # A random last key parts rows that are equal in all else.
    placed = pin(
        narrow.withColumn("salt", F.rand(7))
        .repartitionByRange(*_by_key(), "salt")
        .sortWithinPartitions(*_by_key())
        .select("page_id", "payload_digest", "n", F.spark_partition_id().alias("part"))
    )
    sums = dict(placed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total, before = 0, {}
    for part in sorted(sums):
        before[part], total = total, total + sums[part]
    size = max(shard_bytes, -(-total // most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            if at is None:
                at = before[batch.column(3)[0].as_py()]
            begins = at + np.cumsum(sizes) - sizes
            at = int(begins[-1] + sizes[-1])
            # A shard begins at the first row that begins in its range of bytes; the least of
            # the keys that tasks and batches report is that row's.
            heads = begins // size
            new = np.append(True, heads[1:] != heads[:-1])
            kept = batch.filter(pa.array(new))
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads[new]), kept.column(0), kept.column(1)],
                ["shard", "page_id", "payload_digest"],
            )

    found = placed.mapInArrow(run, "shard bigint, page_id bigint, payload_digest string")
    least = F.min(F.struct("page_id", "payload_digest")).alias("key")
    bounds = found.groupBy("shard").agg(least).orderBy("shard").collect()
    return [(r.key.page_id, r.key.payload_digest) for r in bounds]


def shard_column(bounds: list[tuple[int | None, str]]) -> Column:
    """The shard of a row: that of the last bound not above its ``page_id`` and digest."""
    low = -(1 << 63)
    nulls = sum(page_id is None for page_id, _ in bounds)
    ids = np.array([low if p is None else p for p, _ in bounds], np.int64)
    digests = [d for _, d in bounds]

    @F.pandas_udf("int")
    def place(page_id: pd.Series, known: pd.Series, digest: pd.Series) -> pd.Series:
        out = np.zeros(len(page_id), np.int64)
        values = page_id.to_numpy(np.int64)
        some = known.to_numpy(bool)
        first = np.where(some, nulls + np.searchsorted(ids[nulls:], values, "left"), 0)
        last = np.where(some, nulls + np.searchsorted(ids[nulls:], values, "right"), nulls)
        out[:] = last - 1
        for i in np.flatnonzero(last > first):  # a shard begins inside the rows of this id
            out[i] = bisect.bisect_right(digests, digest.iloc[i], first[i], last[i]) - 1
        return pd.Series(np.maximum(out, 0).astype(np.int32))

    return place(
        F.coalesce("page_id", F.lit(0)), F.col("page_id").isNotNull(), F.col("payload_digest")
    )


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _target(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="/:?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{page_id}"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record; a revisit has the response's HTTP header but no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", CRAWL_DATE),
        ("WARC-Target-URI", _target(url, page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page-ID", str(refers_to)),
            ("WARC-Profile", PROFILE),
        ]
    return _record(headers, block)


class _Roller:
    """Writes the gzip members of one shard into files that close at a compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.base = _file_system(folder)
        self.shard, self.roll_bytes, self.seq, self.out = shard, roll_bytes, 0, None
        self.done: list[dict] = []

    def _open(self) -> None:
        name = f"pages-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.temp = f"_temporary/{uuid.uuid4().hex}-{name}"
        self.out = self.fs.open_output_stream(f"{self.base}/{self.temp}", compression=None)
        self.name, self.size, self.records, self.hash = name, 0, 0, hashlib.sha256()
        fields = f"software: tidepoint\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n"
        info = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", _record_id(None, name)),
            ("WARC-Date", CRAWL_DATE),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ]
        self._put(_record(info, fields.encode()))

    def _put(self, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)

    def add(self, record: bytes) -> None:
        if self.out is not None and self.size >= self.roll_bytes:
            self.close()
        if self.out is None:
            self._open()
        self._put(record)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        self.done.append(
            {
                "shard": self.shard,
                "seq": self.seq,
                "temp": self.temp,
                "name": self.name,
                "records": self.records,
                "bytes": self.size,
                "sha256": self.hash.hexdigest(),
            }
        )
        self.seq += 1


_MANIFEST_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("seq", pa.int32()),
        ("temp", pa.string()),
        ("name", pa.string()),
        ("records", pa.int64()),
        ("bytes", pa.int64()),
        ("sha256", pa.string()),
    ]
)


def write_archive(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write ``pages`` below ``folder`` (a URI all executors reach); returns the manifest."""
    spark = pages.sparkSession
    rows = page_rows(pages)
    bounds = shard_bounds(rows, shard_bytes)
    shard, n_shards = shard_column(bounds), max(1, len(bounds))
    empty = F.lit(None)
    notes = revisits(rows, revisit_bytes).distinct().select(
        shard.alias("shard"), "page_id", "payload_digest", F.lit(0).alias("kind"), "refers_to",
        empty.cast("string").alias("url"), empty.cast("binary").alias("payload"),
    )
    full = rows.select(
        shard.alias("shard"), "page_id", "payload_digest", F.lit(1).alias("kind"),
        empty.cast("bigint").alias("refers_to"), "url", "payload",
    )
    # A payload moves once. A note that a page is a revisit sorts just before the page.
    dealt = (
        full.unionByName(notes)
        .repartitionById(n_shards, F.col("shard"))  # a task for each shard
        .sortWithinPartitions("shard", "page_id", "payload_digest", "kind", "url")
    )
    fs, base = _file_system(folder)
    fs.create_dir(f"{base}/_temporary", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, note = None, None
        for batch in batches:
            columns = (column.to_pylist() for column in batch.columns)
            for shard, page_id, digest, kind, refers_to, url, payload in zip(*columns):
                if kind == 0:
                    note = (page_id, digest, refers_to)
                    continue
                target = note[2] if note and note[:2] == (page_id, digest) else None
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        roller.close()
                        yield pa.RecordBatch.from_pylist(roller.done, _MANIFEST_ARROW)
                    roller = _Roller(folder, shard, roll_bytes)
                roller.add(page_record(page_id, url, payload, digest, target))
        if roller is not None:
            roller.close()
            yield pa.RecordBatch.from_pylist(roller.done, _MANIFEST_ARROW)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source = f"{base}/{row['temp']}"
                # A repeated task attempt finds the file under its final name.
                if fs.get_file_info(source).type != pafs.FileType.NotFound:
                    fs.move(source, f"{base}/{row['name']}")
            yield batch

    reported = f"{folder}/_reported"
    dealt.mapInArrow(write, MANIFEST).write.mode("overwrite").json(reported)
    listed = spark.read.schema(MANIFEST).json(reported)
    named = listed.mapInArrow(rename, MANIFEST).drop("temp")
    named.write.mode("overwrite").json(f"{folder}/manifest")
    fs.delete_dir(f"{base}/_temporary")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    schema = MANIFEST.replace("temp string, ", "")
    return spark.read.schema(schema).json(f"{folder}/manifest")


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a stream of gzip members, one at a time."""
    rest = b""
    while True:
        if not rest:
            rest = stream.read(chunk)
            if not rest:
                return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                rest = stream.read(chunk)
                if not rest:
                    raise ValueError("the archive ends inside a record")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The headers, lower-cased names, and the block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a record: {first[:40]!r}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def _page(headers: dict[str, str], block: bytes) -> dict:
    """A page row from a record, after its digests have been tested against its content."""
    if headers["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError(f"damaged record {headers['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and digest != hashlib.sha1(payload).hexdigest():
        raise ValueError(f"damaged payload in {headers['warc-record-id']}")
    page_id, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    return {
        "page_id": None if page_id is None else int(page_id),
        "url": headers["warc-target-uri"],
        "record_type": kind,
        "refers_to": None if refers is None else int(refers),
        "payload_bytes": int(fields["Content-Length"]),
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


_READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("file", pa.string()),
    ]
)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The page records of a committed archive, files spread over tasks, streamed in each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        headers, block = parse_record(member)
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(_page(headers, block) | {"file": name})
                        held += len(block)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ_ARROW)

    manifest = read_manifest(spark, folder)
    files = manifest.select("name").repartition(
        max(1, spark.sparkContext.defaultParallelism), "name"
    )
    return files.mapInArrow(read, READ_SCHEMA)
