"""The prefix trie of conversations that share their first turns.

Each conversation becomes a chain of prefix digests, one per depth, in one pass over its
turns; texts do not move, only 128-bit hashes and lengths. A count-min sketch of all prefix
digests screens them: where one of a digest's cells has counted a single prefix, the estimate
is one, which proves that no other conversation has it. From the first such depth on a
conversation is alone; that tail is emitted where it is. Only the prefixes before it, which
may be shared, are shuffled and grouped exactly, so the sketch decides what moves, never the
result. The sketch grows with the prefixes up to ``MAX_CELLS`` a row (3 bits a cell are
broadcast, 24 MB at most); beyond that more singletons go to the exact grouping.

Grouping is by digest, combined before it moves. A node belongs to its smallest member, its
owner. Along a conversation the depths it owns are the last ones, so a subtree's sums need no
walk: over the members of a node, what each counts below the node, less what it does not own.
The two joins with groups broadcast the heaviest ones, a bounded number.

Conversations are rebuilt first: some turns of the first one of their hundred, then their own.
Defined cases: null roles and texts are empty; rows without ``conv_id`` belong to no
conversation; turns of equal number are ordered by a hash of role and text; one conversation
streams through one task at 24 bytes a turn; an empty table gives no rows. Columns besides
``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.llm.skew import join_groups
from tidepoint.session import pin

HEAD = 6  # a head has fewer turns than this
FAMILY = 100
SKETCH_ROWS = 3
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 26
SEGMENT = 1 << 16
FLUSH = 1 << 21
ENDS_IN_CHUNK = 512

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROOT = bytes(16)

NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


# Chains


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns in the order of rebuilding: the first of each hundred conversations, then others."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("bigint")
    rows = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("first"),
        conv.alias("conv_id"),
        (F.crc32(conv.cast("string").cast("binary")) % HEAD).alias("head"),
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("digest"),
        F.char_length(text).cast("bigint").alias("size"),
    )
    placed = rows.repartition("first").sortWithinPartitions(
        "first",
        F.col("conv_id") != F.col("first"),
        "conv_id",
        F.col("turn").asc_nulls_first(),
        "digest",
    )
    return placed.select("first", "conv_id", "head", "digest", "size")


_CHAINS = "conv_id bigint, turns bigint, digests binary, sizes binary"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests and turn sizes of each rebuilt conversation."""
    family, lead = None, []
    conv, state, own = None, ROOT, 0
    digests, sizes = bytearray(), []
    out = []

    def push(turn: bytes, size: int) -> None:
        nonlocal state
        state = hashlib.sha256(state + turn).digest()[:16]
        digests.extend(state)
        sizes.append(size)

    def done() -> None:
        out.append((conv, len(sizes), bytes(digests), np.array(sizes, "<i8").tobytes()))

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], _columns(_CHAINS)
        )

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for first, conv_id, head, digest, size in zip(*columns):
            if conv_id != conv:
                if conv is not None:
                    done()
                if first != family:
                    family, lead = first, []
                conv, state, own = conv_id, ROOT, 0
                digests, sizes = bytearray(), []
                if conv_id != first:
                    for turn in lead[:head]:
                        push(*turn)
            if conv_id == first:
                if len(lead) < HEAD - 1:
                    lead.append((digest, size))
                push(digest, size)
            elif own >= head:
                push(digest, size)
            own += 1
        if out:
            yield batch_of()
            out.clear()
    if conv is not None:
        done()
        yield batch_of()


def chains(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns, digests, sizes`` of the rebuilt conversations."""
    return _turns(conversations).mapInArrow(_chain, _CHAINS)


# Screening


def _cells(digests: np.ndarray, width: int) -> np.ndarray:
    """Cells of each digest (``n x 16`` bytes), one per row of the sketch."""
    words = digests.view("<u4")[:, :SKETCH_ROWS].astype(np.int64)
    return (words & (width - 1)) + np.arange(SKETCH_ROWS) * width


def _digests(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, 16)


def _count(width: int):
    """Cells of a task's prefixes by segment; a cell comes twice if it was met again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            cells = np.repeat(cells, np.minimum(counts, 2))
            segments, begin = np.unique(cells // SEGMENT, return_index=True)
            packed = [p.astype("<u2").tobytes() for p in np.split(cells % SEGMENT, begin[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(segments), pa.array(packed, pa.binary())], ["segment", "cells"]
            )

        for batch in batches:
            cells = _cells(_digests(batch.column(0)), width).ravel()
            if len(cells):
                held.append(cells)
                n += len(cells)
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``segment, bits``: which cells count two prefixes or more."""
    now, counts = None, np.zeros(SEGMENT, np.int64)

    def out() -> pa.RecordBatch:
        bits = np.packbits(counts > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int64()), pa.array([bits], pa.binary())], ["segment", "bits"]
        )

    for batch in batches:
        for segment, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if segment != now:
                if now is not None:
                    yield out()
                now, counts = segment, np.zeros(SEGMENT, np.int64)
            counts += np.bincount(np.frombuffer(cells, "<u2"), minlength=SEGMENT)
    if now is not None:
        yield out()


def sketch_width(prefixes: int, max_cells: int = MAX_CELLS) -> int:
    """Cells in a row of the sketch: about four times the prefixes, a power of two."""
    return min(max_cells, max(MIN_CELLS, 1 << (4 * max(1, prefixes) - 1).bit_length()))


def count_min(chained: DataFrame, width: int) -> np.ndarray:
    """Bits, one per cell of all rows: set where the sketch counts two prefixes or more."""
    sent = chained.select("digests").mapInArrow(_count(width), "segment bigint, cells binary")
    merged = (
        sent.repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(_merge, "segment bigint, bits binary")
    )
    bits = np.zeros(SKETCH_ROWS * width // 8, np.uint8)
    for row in merged.collect():
        part = np.frombuffer(row.bits, np.uint8)
        bits[row.segment * (SEGMENT // 8) :][: len(part)] = part
    return bits


def _met_again(digests: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Whether the estimate of each digest is above one."""
    cells = _cells(digests, width)
    return ((bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)


def _screened(batch: pa.RecordBatch, bits: np.ndarray, width: int):
    """Per conversation: id, turns, digests, sizes, and how many depths may be shared."""
    for conv, turns, data, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
        digests = np.frombuffer(data, np.uint8).reshape(-1, 16)
        again = _met_again(digests, bits, width)
        shared = turns if again.all() else int(np.argmin(again))
        yield conv, turns, data, np.frombuffer(size, "<i8"), shared


_SHARED = (
    "digest binary, depth bigint, conv_id bigint, turns bigint, rest bigint, below bigint"
)


def _shared_prefixes(bits, width: int):
    """The prefixes that may be shared; ``rest`` is the size from there on, ``below`` after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, depth, convs, turns, rest, below = [], [], [], [], [], []
            for conv, n, data, sizes, shared in _screened(batch, bits.value, width):
                digests.append(ROOT)
                digests += [data[16 * d : 16 * d + 16] for d in range(shared)]
                after = int(sizes.sum()) - np.concatenate([[0], np.cumsum(sizes[:shared])])
                depth.append(np.arange(shared + 1))
                convs.append(np.full(shared + 1, conv, np.int64))
                turns.append(np.full(shared + 1, n, np.int64))
                below.append(after)
                rest.append(np.append(after[:1], after[:-1]))
            if digests:
                numbers = (np.concatenate(c) for c in (depth, convs, turns, rest, below))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), *(pa.array(c, pa.int64()) for c in numbers)],
                    _columns(_SHARED),
                )

    return run


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _tails(bits, width: int):
    """Nodes of one conversation alone whose parent is such a node too, as ``NODES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, depths, children, ends = [], [], [], []
            for conv, n, _, _, shared in _screened(batch, bits.value, width):
                own = n - shared - 1
                if own > 0:
                    convs.append(np.full(own, conv, np.int64))
                    depths.append(np.arange(shared + 2, n + 1))
                    children.append(np.append(np.ones(own - 1, np.int64), 0))
                    ends += [EMPTY_SHA] * (own - 1) + [_sha(str(conv))]
            if convs:
                conv, depth, child = (np.concatenate(c) for c in (convs, depths, children))
                one = np.ones(len(conv), np.int64)
                columns = [conv, depth, conv, one, child, one, one * 0]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array(ends)],
                    _columns(NODES),
                )

    return run


# Conversations that end at a node


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, joined by commas, some hundred a row: ``digest, first, ids``."""
    names, kinds = ["digest", "first", "ids"], [pa.binary(), pa.int64(), pa.string()]
    for batch in batches:
        out, now, ids = [], None, []
        for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest != now or len(ids) == ENDS_IN_CHUNK:
                if ids:
                    out.append((now, ids[0], ",".join(map(str, ids))))
                now, ids = digest, []
            ids.append(conv)
        if ids:
            out.append((now, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names
            )


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One running digest per node over its chunks: ``digest, ends_sha256``."""
    now, running, out = None, None, []

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["digest", "ends_sha256"]
        )

    for batch in batches:
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest != now:
                if now is not None:
                    out.append((now, running.hexdigest()))
                now, running = digest, hashlib.sha256(ids.encode())
            else:
                running.update(f",{ids}".encode())
        if out:
            yield batch_of()
            out.clear()
    if now is not None:
        out.append((now, running.hexdigest()))
        yield batch_of()


def ends_of(records: DataFrame) -> DataFrame:
    """``digest, ends_sha256`` of the nodes at which conversations end.

    The ids of one node are sorted over many tasks; one task reads only the joined chunks.
    """
    ends = records.where("depth = turns").select("digest", "conv_id")
    chunks = (
        ends.repartitionByRange("digest", "conv_id")
        .sortWithinPartitions("digest", "conv_id")
        .mapInArrow(_chunks, "digest binary, first bigint, ids string")
    )
    return (
        chunks.repartition("digest")
        .sortWithinPartitions("digest", "first")
        .select("digest", "ids")
        .mapInArrow(_hash_ends, "digest binary, ends_sha256 string")
    )


# Nodes


def _owned(records: DataFrame) -> DataFrame:
    """Records with ``owner`` and, per conversation, what it does not own: ``until`` the last
    such depth (-1: none), ``above`` the owner there, ``own`` the size it owns, ``leaf``."""
    groups = pin(
        records.groupBy("digest").agg(
            F.count("*").alias("n"),
            F.min("conv_id").alias("owner"),
            F.max("turns").alias("deepest"),
        )
    )
    met = join_groups(records, groups, "digest", "n", "conv_id")
    foreign = F.when(
        F.col("owner") != F.col("conv_id"), F.struct("depth", F.col("owner").alias("o"), "below")
    )
    at_end = (F.col("depth") == F.col("turns")) & (F.col("deepest") == F.col("turns"))
    at_end &= F.col("owner") == F.col("conv_id")

    def over(column, name: str):
        return F.expr(f"max({column}) over (partition by conv_id)").alias(name)

    rows = met.select(
        *_columns(_SHARED), "owner", foreign.alias("foreign"), at_end.alias("at_end")
    ).select(
        *_columns(_SHARED),
        over("foreign", "last"),
        over("depth", "shared"),
        over("rest", "all"),
        over("at_end", "ended"),
    )
    return rows.select(
        *_columns(_SHARED),
        "shared",
        F.coalesce("last.depth", F.lit(-1)).alias("until"),
        F.col("last.o").alias("above"),
        F.coalesce("last.below", "all").alias("own"),
        (F.col("ended") | (F.col("turns") > F.col("shared"))).cast("bigint").alias("leaf"),
    )


def prefix_trie(conversations: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """A row per node, see ``NODES``."""
    chained = pin(chains(conversations))
    prefixes = chained.agg(F.sum("turns").alias("n")).first().n or 0
    width = sketch_width(prefixes, max_cells)
    bits = chained.sparkSession.sparkContext.broadcast(count_min(chained, width))
    records = pin(chained.mapInArrow(_shared_prefixes(bits, width), _SHARED))
    tails = chained.mapInArrow(_tails(bits, width), NODES)
    owned = pin(_owned(records))

    depth, until = F.col("depth"), F.col("until")
    parent = F.when(
        (depth > until) & (depth > 0),
        F.when(depth - 1 == until, F.col("above")).otherwise(F.col("conv_id")),
    )
    counted = F.when(depth > until, F.col("rest")).otherwise(F.col("own"))
    child = (F.col("turns") > depth) & (depth >= until)
    shared = owned.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max(parent).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(child.cast("bigint")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("rest") - counted).alias("saved_tokens"),
    )
    nodes = shared.join(ends_of(records), "digest", "left").select(
        *_columns(NODES)[:-1], F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")
    )
    last = F.col("turns") == depth + 1
    tops = owned.where("depth = shared and turns > shared").select(
        "conv_id",
        (depth + 1).alias("depth"),
        F.when(until == depth, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
        .otherwise(F.lit(EMPTY_SHA))
        .alias("ends_sha256"),
    )
    return nodes.unionByName(tops).unionByName(tails)
