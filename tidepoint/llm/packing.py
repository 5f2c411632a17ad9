"""Packing documents into training sequences by lexical retrieval.

Documents are tokenized once. A document longer than a window fills whole windows by itself;
what is left of it, or a shorter document, is a piece. Document frequencies, the number of
pieces and their mean length are counted over the whole corpus (a count per token id of the
vocabulary), so a term weighs the same everywhere.

Pieces that are lexically related are dealt together: the corpus is range partitioned in an
order by clusters and sampled terms, see ``related``, and a task cuts its range into shards of
bounded size. Each shard has a BM25 inverted index with the weights of the whole corpus. The first unused piece is the seed of a window, all terms it shares are scored, and its
best unused neighbours fill the window in the order of their scores. The neighbour that does
not fit is cut, and its rest remains to be packed, so every window is full. A window never has
two rows of one id, such as two readings of a document. What cannot fill a window at the end
of a shard goes into sequences whose lengths are powers of two. No sequence needs padding.

Defined cases: a null or empty text has only the end token; rows that repeat an id are packed
each; a null id is packed like any other, and rows without id may share a window; an empty
table gives no rows. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.llm.related import SAMPLE, Statistics, TermTable, fit_centres, sort_keys
from tidepoint.llm.tokens import added_tokens, default_vocabulary, encoding
from tidepoint.session import pin

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20
SHARD_PIECES = 1 << 13
SHARDS_IN_TASK = 4
PART_TOKENS = 1 << 18
COMPACT = 8

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, shard bigint"
)


def tokenized(docs: DataFrame, vocabulary: str, pattern: str, end_id: int) -> DataFrame:
    """``doc_id, ids, wide``: the ids as unsigned 16-bit integers where they fit, else 32.

    Added tokens of the vocabulary are found inside texts, as ``tokenizers`` does.
    """
    added = added_tokens(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary, pattern, added)
        width = "<u2" if max(encoder.max_token_value, end_id) < 1 << 16 else "<u4"
        for batch in batches:
            packed = []
            for text in batch.column(1):
                ids = encoder.encode_to_numpy(text.as_py() or "", allowed_special="all")
                packed.append(np.append(ids, end_id).astype(width).tobytes())
            wide = pa.array([width == "<u4"] * len(packed), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), wide], ["doc_id", "ids", "wide"]
            )

    return docs.mapInArrow(run, "doc_id bigint, ids binary, wide boolean")


def _arrays(batch: pa.RecordBatch, ids: int, wide: int) -> Iterator[np.ndarray]:
    for data, w in zip(batch.column(ids).to_pylist(), batch.column(wide).to_pylist()):
        yield np.frombuffer(data, "<u4" if w else "<u2")


def _piece(ids: np.ndarray, window: int) -> np.ndarray:
    return ids[len(ids) // window * window :]


def _parts(pieces: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Lists of pieces of about ``PART_TOKENS`` together."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= PART_TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _term_counts(window: int):
    """Pieces per term in one task; -1 counts pieces and -2 their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(1 << 16, np.int64), 0, 0
        for pieces in _parts((_piece(i, window) for b in batches for i in _arrays(b, 0, 1))):
            own = np.bincount(TermTable.of(pieces).terms, minlength=len(df))
            df = own + np.append(df, np.zeros(len(own) - len(df), np.int64))
            n += sum(len(p) > 0 for p in pieces)
            tokens += sum(map(len, pieces))
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(terms, [-1, -2])), pa.array(np.append(df[terms], [n, tokens]))],
            ["term", "n"],
        )

    return run


def statistics(tokens: DataFrame, window: int = WINDOW) -> tuple[Statistics, int]:
    """Weights over all pieces and their number. What is collected: two numbers, and one per
    token id, so never more than the vocabulary."""
    counted = tokens.select("ids", "wide").mapInArrow(_term_counts(window), "term bigint, n bigint")
    rows = dict(counted.groupBy("term").agg(F.sum("n")).collect())
    n, total = rows.pop(-1, 0), rows.pop(-2, 0)
    df = np.zeros(max(rows, default=0) + 1, np.int64)
    df[list(rows)] = list(rows.values())
    return Statistics.of(df, n, total), n


def centres_of(tokens: DataFrame, stats: Statistics, n: int, window: int = WINDOW) -> np.ndarray:
    """Centres fitted on distinct pieces whose hash falls in a share of about ``SAMPLE`` of ``n``."""
    width = F.when(F.col("wide"), 4).otherwise(2) * window
    length = F.octet_length("ids")
    tail = F.expr("substring(ids, whole + 1, length - whole)")
    pieces = (
        tokens.select("ids", "wide", length.alias("length"), (length - length % width).alias("whole"))
        .where("length > whole")
        .select(tail.alias("piece"), "wide")
        .withColumn("hash", F.xxhash64("piece"))
        .where(F.pmod("hash", F.lit(max(1, n))) < SAMPLE)
        .groupBy("hash")
        .agg(F.first("piece").alias("piece"), F.first("wide").alias("wide"))
        .limit(2 * SAMPLE)
    )
    rows = sorted(pieces.collect(), key=lambda r: r.hash)
    return fit_centres([np.frombuffer(r.piece, "<u4" if r.wide else "<u2") for r in rows], stats)


def _with_keys(window: int, stats: Statistics, centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = (_piece(ids, window) for ids in _arrays(batch, 1, 2))
            keys = [k for part in _parts(pieces) for k in sort_keys(part, stats, centres)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), *batch.columns], ["key", *batch.schema.names]
            )

    return run


class Index:
    """BM25 over the token ids of the pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], stats: Statistics):
        table = TermTable.of(pieces)
        lengths = np.fromiter(map(len, pieces), np.float32, len(pieces))
        weights = stats.weights(table.terms, table.counts, lengths[table.pieces])
        order = np.argsort(table.terms, kind="stable")
        _, self.number = np.unique(table.terms, return_inverse=True)
        self.begin = table.begin
        self.used = np.zeros(len(pieces), bool)
        self._hold(self.number[order], table.pieces[order], weights[order])

    def _hold(self, terms: np.ndarray, docs: np.ndarray, weights: np.ndarray) -> None:
        """Postings, sorted by term."""
        self.terms, self.docs, self.weights = terms, docs, weights
        ends = np.cumsum(np.bincount(terms, minlength=int(self.number.max(initial=-1)) + 1))
        self.first, self.last = np.append(0, ends[:-1]), ends
        self.held = int((~self.used).sum())

    def _compact(self) -> None:
        """Let go of the postings of used pieces, once they are one in ``COMPACT``."""
        free = int((~self.used).sum())
        if self.held - free > self.held // COMPACT:
            kept = ~self.used[self.docs]
            self._hold(self.terms[kept], self.docs[kept], self.weights[kept])

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused pieces that share a term with the seed, best first; all its terms count."""
        self._compact()
        terms = self.number[self.begin[seed] : self.begin[seed + 1]]
        first, last = self.first[terms], self.last[terms]
        shared = last > first
        spans = list(map(slice, first[shared].tolist(), last[shared].tolist()))
        if not spans:
            return np.zeros(0, np.int64)
        found = np.concatenate([self.docs[s] for s in spans])
        scores = np.bincount(found, np.concatenate([self.weights[s] for s in spans]))
        scores[self.used[: len(scores)]] = 0
        scores[seed : seed + 1] = 0
        hits = np.flatnonzero(scores)
        return hits[np.argsort(-scores[hits], kind="stable")]


def pack(
    pieces: list[np.ndarray],
    stats: Statistics,
    owners: list[int | None],
    window: int = WINDOW,
) -> list[tuple[int, int, int, int, int]]:
    """Cuts ``(piece, start, length, sequence, offset)`` of pieces shorter than a window.

    ``owners``: the id each piece belongs to.
    """
    index = Index(pieces, stats)
    names: dict[int | None, int] = {}
    owner = np.array(
        [-1 - i if o is None else names.setdefault(o, len(names)) for i, o in enumerate(owners)]
    )
    begin = [0] * len(pieces)
    out: list[tuple[int, int, int, int, int]] = []
    sequence = first = 0
    while True:
        while first < len(pieces) and index.used[first]:
            first += 1
        if first == len(pieces):
            return out
        cuts: list[tuple[int, int, int]] = []
        filled, inside = 0, set()
        seed = first
        while True:
            for i in (seed, *index.neighbours(seed)):
                if owner[i] in inside:
                    continue
                length = min(len(pieces[i]) - begin[i], window - filled)
                cuts.append((i, begin[i], length))
                begin[i] += length
                filled += length
                index.used[i] = begin[i] == len(pieces[i])
                inside.add(owner[i])
                if filled == window:
                    break
            if filled == window:
                break
            free = ~index.used[first:]
            others = np.flatnonzero(free & ~np.isin(owner[first:], list(inside)))
            if not len(others):
                break
            seed = first + int(others[0])
        # A full window, or what can only go into powers of two.
        while cuts:
            size = 1 << (filled.bit_length() - 1) if filled < window else window
            offset = 0
            while offset < size:
                i, start, length = cuts.pop(0)
                own = min(length, size - offset)
                out.append((i, start, own, sequence, offset))
                if own < length:
                    cuts.insert(0, (i, start + own, length - own))
                offset += own
            filled, sequence = filled - size, sequence + 1


def _packer(window: int, stats: Statistics, shard_tokens: int):
    names = [part.split()[0] for part in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, np.ndarray, int]] = []
        tokens = sequence = shard = part = 0
        out: list[tuple] = []

        def add(doc_id, start, ids, doc_tokens, sequence, offset) -> None:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            number = (part << 20) + shard
            place = (part << 40) + sequence
            out.append((doc_id, start, len(ids), crc, doc_tokens, place, offset, number))

        def settle() -> None:
            nonlocal held, tokens, sequence, shard
            cuts = pack([h[2] for h in held], stats, [h[0] for h in held], window)
            for i, start, length, at, offset in cuts:
                doc_id, before, piece, doc_tokens = held[i]
                own = piece[start : start + length]
                add(doc_id, before + start, own, doc_tokens, sequence + at, offset)
            sequence += 1 + max(c[3] for c in cuts)
            held, tokens, shard = [], 0, shard + 1

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for doc_id, at, ids in zip(ids_of, batch.column(1).to_pylist(), _arrays(batch, 2, 3)):
                part, whole = at, len(ids) // window * window
                for start in range(0, whole, window):
                    add(doc_id, start, ids[start : start + window], len(ids), sequence, 0)
                    sequence += 1
                if whole < len(ids):
                    held.append((doc_id, whole, ids[whole:], len(ids)))
                    tokens += len(ids) - whole
                if tokens >= shard_tokens or len(held) >= SHARD_PIECES:
                    settle()
                if len(out) >= SHARD_PIECES:
                    yield batch_of()
        if held:
            settle()
        if out:
            yield batch_of()

    return run


def packed_pieces(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    pattern: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A row per piece, see ``PIECES``. ``sequence_id`` is unique over all shards.

    ``vocabulary``: path of token ranks in the tiktoken format, the same on all executors.
    """
    vocabulary, pattern = default_vocabulary(vocabulary, pattern)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tokens = pin(tokenized(rows, vocabulary, pattern, end_id))
    stats, n = statistics(tokens, window)
    centres = centres_of(tokens, stats, n, window)
    keyed = tokens.mapInArrow(
        _with_keys(window, stats, centres), "key binary, doc_id bigint, ids binary, wide boolean"
    )
    size = tokens.agg(F.sum(F.octet_length("ids")).alias("n")).first().n or 0
    tasks = max(1, -(-size // (2 * shard_tokens * SHARDS_IN_TASK)))
    # The row's place in storage parts rows that are equal in all else.
    placed = keyed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        tasks, "key", "doc_id", "row"
    )
    ordered = placed.sortWithinPartitions("key", "doc_id", "row")
    return ordered.select(
        "doc_id", F.spark_partition_id().cast("bigint").alias("part"), "ids", "wide"
    ).mapInArrow(_packer(window, stats, shard_tokens), PIECES)
