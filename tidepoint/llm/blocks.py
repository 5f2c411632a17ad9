"""Documents in blocks of bounded size, and compact messages to and from them.

Operators that compare all positions of all texts send arrays, not rows: one message holds
what one batch of documents has for one group, as packed integers. Answers come back to the
block of a document, a hash of its id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.llm.words import mix

NULL_ID = np.iinfo(np.int64).min  # a null id orders before every other id
_U = np.uint64


def pack(values: np.ndarray) -> bytes:
    """Integers as offsets from their least, in the fewest whole bytes of 1, 2, 4 or 8; equal
    ones as their number."""
    values = np.asarray(values)
    if not len(values):
        return b""
    low = int(values.min())
    spread = int(values.max()) - low
    if not spread:
        return bytes([0]) + np.int64(low).tobytes() + np.int64(len(values)).tobytes()
    width = next(w for w in (1, 2, 4, 8) if spread < 1 << (8 * w))
    with np.errstate(over="ignore"):
        offsets = (values.astype(np.int64) - np.int64(low)).view(_U).astype(f"<u{width}")
    return bytes([width]) + np.int64(low).tobytes() + offsets.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    low = np.frombuffer(data, np.int64, 1, 1)[0]
    if not data[0]:
        return np.full(int(np.frombuffer(data, np.int64, 1, 9)[0]), low)
    with np.errstate(over="ignore"):
        return np.frombuffer(data, f"<u{data[0]}", offset=9).astype(_U).view(np.int64) + low


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


def block_numbers(ids: np.ndarray, n: int) -> np.ndarray:
    """What ``block_column`` gives: XXH64 with seed 42 of the 8 bytes of an id, modulo n."""
    p1, p2, p3 = _U(0x9E3779B185EBCA87), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
    p4, p5 = _U(0x85EBCA77C2B2AE63), _U(0x27D4EB2F165667C5)
    h = np.full(len(ids), _U(42) + p5 + _U(8), _U)
    h ^= _rotate(ids.astype(np.int64).view(_U) * p2, 31) * p1
    h = _rotate(h, 27) * p1 + p4
    h ^= h >> _U(33)
    h *= p2
    h ^= h >> _U(29)
    h *= p3
    h ^= h >> _U(32)
    return np.mod(h.view(np.int64), n)


def id_column() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(NULL_ID)))


def block_column(n: int) -> Column:
    return F.pmod(F.xxhash64(id_column()), F.lit(n)).cast("bigint")


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text") + 1).alias("n")).first().n or 0


def ids_repeat(docs: DataFrame) -> bool:
    """Whether an id stands for several rows, which then need tags to be told apart."""
    counted = docs.groupBy(id_column().alias("id")).count()
    return not counted.where("count > 1").isEmpty()


class Batch:
    """Texts of some documents in the order of their ids.

    ``tagged``: rows of one id are told apart by 64-bit hashes of their texts; else, where no
    id repeats, all tags are 0 and take no room.
    """

    def __init__(self, ids: list[int | None], texts: list[bytes | None], tagged: bool = True):
        order = sorted(range(len(ids)), key=lambda i: NULL_ID if ids[i] is None else ids[i])
        self.ids = np.array([NULL_ID if ids[i] is None else ids[i] for i in order], np.int64)
        self.texts = [texts[i] or b"" for i in order]
        tags = [xxhash.xxh64_intdigest(t) if tagged else 0 for t in self.texts]
        self.tags = np.array(tags, _U).view(np.int64)


def document_batches(
    batches: Iterator[pa.RecordBatch], limit: int, tagged: bool = True
) -> Iterator[Batch]:
    """Batches of about ``limit`` bytes from ``doc_id, text``; at least one document each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        own = batch.column(1).cast(pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column(0).to_pylist(), own):
            if ids and size + len(text or b"") > limit:
                yield Batch(ids, texts, tagged)
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text or b"")
    if ids:
        yield Batch(ids, texts, tagged)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))


def doc_headers(ids: np.ndarray, tags: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Packed ids, tags and counts of neighbouring equal documents."""
    first = np.flatnonzero(
        np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])) if len(ids) else []
    )
    counts = np.diff(np.append(first, len(ids)))
    return pack(ids[first]), pack(tags[first]), pack(counts)


def expand_headers(ids: bytes, tags: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = unpack(counts)
    return np.repeat(unpack(ids), n), np.repeat(unpack(tags), n)


def by_document(ids: np.ndarray, tags: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Indices of the entries of each document."""
    order = np.lexsort((tags, ids))
    i, t = ids[order], tags[order]
    first = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (t[1:] != t[:-1])) if len(i) else [])
    return {
        (int(i[a]), int(t[a])): order[a:b] for a, b in zip(first, np.append(first[1:], len(i)))
    }


def spread(keys: np.ndarray, n: int) -> np.ndarray:
    """Groups of 64-bit keys, by bits that the keys' order does not use."""
    return (mix(keys) % _U(n)).astype(np.int64)
