"""Repeated passages of words, by suffix trees partitioned by prefix.

Of the suffixes of a text only those that begin at anchors are dealt: the anchor of a window is
the place of the least hash among its grams of ``GRAM`` words, the first of equal ones. Equal
windows have their anchors at the same place in them, so the suffixes from there share their
first words and meet. The windows of one anchor are its region, at most 22 words for windows
of 13.

Suffixes are dealt into groups by their first words, and a group is what one task holds.
Prefixes are as long as they must be. The six-bit digits of the first two words are counted
over all documents; neighbouring light prefixes share a group, which amounts to a shorter
prefix; a prefix with more suffixes than a group may have is lengthened to the gram, and one
with more than ``HOT`` places to the whole window. Groups first hear of hashes only. What
occurs once in the corpus is never looked at again; of the rest, the regions' words follow.

In a group, the regions' words are numbered in their lexical order, and the suffixes of all
regions are sorted by doubling. Common prefixes of neighbours, compared word by word, give the
intervals of the tree; those at least a window deep are its internal nodes that stand for
repeats. Neighbouring windows below such nodes together are the maximal repeats. A node's
smallest document keeps its words, those of the other leaves go. Hashes only bring suffixes
together: windows that differ in a word are never taken for equal.

Before regions move, each task settles those that are equal in its own documents and sends on
only the ones of the smallest document, so a passage that a third of all documents share
arrives once per task.

Words are runs of characters other than space and 9 to 13. Defined cases: null, empty and
short texts lose nothing; a repeat inside one document is kept; rows that share an id never
remove each other's words, and copies of a row get the same result; a null id orders before
every other id; an empty table gives no rows. Columns besides ``doc_id`` and ``text`` are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.llm.blocks import (
    NULL_ID,
    Batch,
    block_column,
    block_numbers,
    by_document,
    doc_headers,
    document_batches,
    expand_headers,
    ids_repeat,
    pack,
    runs,
    spread,
    text_bytes,
    unpack,
)
from tidepoint.llm.bytespans import _HOT_BLOCK, _KNOWN, _SENT, _known_anchors, _parts, _table
from tidepoint.llm.words import gram_fingerprints, slices, word_fingerprints
from tidepoint.session import scratch_path

WINDOW = 13
GRAM = 4
DIGIT = 64
GROUP_SUFFIXES = 300_000
BATCH_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
HOT = 20_000  # places of an anchor in the whole corpus

_U = np.uint64
_REGIONS = (
    "grp bigint, ids binary, tags binary, counts binary, places binary, windows binary, "
    "content binary"
)
_MARKS = "block bigint, ids binary, tags binary, counts binary, places binary, lengths binary"


class Suffixes(NamedTuple):
    """Suffixes from anchors, in the order of their texts, as arrays."""

    doc: np.ndarray  # number of the text
    number: np.ndarray  # of the suffix in its text
    start: np.ndarray  # word at which its region begins
    windows: np.ndarray  # in its region
    code: np.ndarray  # digits of its first two words
    anchor: np.ndarray  # hash of its first ``GRAM`` words


def anchored_suffixes(texts: list[bytes], window: int) -> Suffixes:
    gram = min(GRAM, window)
    parts = []
    for begin, end in slices(texts):
        words, offsets = word_fingerprints(texts[begin:end])
        n = len(words) - window + 1
        if n <= 0:
            continue
        docs = np.repeat(np.arange(end - begin, dtype=np.int32), np.diff(offsets))
        grams = gram_fingerprints(words, gram)
        least, at = grams[:n].copy(), np.zeros(n, np.int8)
        for k in range(1, window - gram + 1):
            less = grams[k : n + k] < least
            np.copyto(least, grams[k : n + k], where=less)
            at[less] = k
        spot = np.flatnonzero(docs[:n] == docs[window - 1 :])
        if not len(spot):
            continue
        place = spot + at[spot]
        head = runs(place)
        first, place = spot[head], place[head]
        doc = docs[first]
        number = np.arange(len(doc))
        of_doc = runs(doc)
        number -= np.repeat(of_doc, np.diff(np.append(of_doc, len(doc))))
        digits = np.append((words >> _U(58)).astype(np.int16), np.int16(0))
        parts.append((
            doc + begin,
            number,
            first - offsets[doc],
            np.diff(np.append(head, len(spot))),
            digits[place] * DIGIT + digits[place + 1],
            least[first],
        ))
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, _U)
    if not parts:
        return Suffixes(*(np.zeros(0, k) for k in kinds))
    return Suffixes(*(np.concatenate(c).astype(k) for c, k in zip(zip(*parts), kinds)))


def prefix_groups(counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First group and number of groups of each prefix, and how many groups there are."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    group, filled = 0, 0
    for code, n in enumerate(counts):
        if filled and filled + n > limit:
            group, filled = group + 1, 0
        first[code] = group
        if n > limit:
            parts[code] = -(-int(n) // limit)
            group, filled = group + int(parts[code]), 0
        else:
            filled += n
    return first, parts, group + 1


def _count(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIGIT * DIGIT, np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            total += np.bincount(anchored_suffixes(texts, window).code, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    return run


class Groups(NamedTuple):
    """Where prefixes go: first group and number of groups of each two words' digits."""

    first: np.ndarray
    parts: np.ndarray
    total: int

    def of(self, code: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return self.first[code] + spread(anchor, 1 << 62) % self.parts[code]


def _send_hashes(window: int, groups: Groups, n_blocks: int, tagged: bool):
    """Anchors to their groups. Those that a batch has twice are known to repeat already:
    they go back under -1 - block, and their group hears of them once, without a place but
    with the number of their places."""

    def settle(batch: Batch) -> Iterator[list]:
        found = anchored_suffixes(batch.texts, window)
        if not len(found.doc):
            return
        group = groups.of(found.code, found.anchor)
        order = np.argsort(found.anchor, kind="stable")
        begin = runs(found.anchor[order])
        sizes = np.diff(np.append(begin, len(order)))
        twice = np.zeros(len(order), bool)
        twice[order] = np.repeat(sizes > 1, sizes)

        def message(key: int, own: np.ndarray, hashes: bytes) -> list:
            doc = found.doc[own]
            heads = doc_headers(batch.ids[doc], batch.tags[doc])
            return [key, *heads, hashes, pack(found.number[own])]

        at = np.flatnonzero(twice)
        for block, part in _parts(block_numbers(batch.ids[found.doc[at]], n_blocks)):
            yield message(-1 - block, at[part], b"")
        at = np.flatnonzero(~twice)
        for key, part in _parts(group[at]):
            yield message(key, at[part], found.anchor[at[part]].tobytes())
        heads, many = order[begin[sizes > 1]], sizes[sizes > 1]
        none = doc_headers(np.zeros(0, np.int64), np.zeros(0, np.int64))
        for key, part in _parts(group[heads]):
            yield [key, *none, found.anchor[heads[part]].tobytes(), pack(many[part])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in document_batches(batches, BATCH_BYTES, tagged):
            yield from _table(list(settle(batch)), _SENT).to_batches()

    return run


def _regions(window: int, groups: Groups, n_blocks: int, above: np.ndarray, tagged: bool):
    """Regions of the repeated anchors of one block, to the groups of their prefixes.

    ``above``: the anchors with very many places, sorted.
    """

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        rows = known.to_pylist()
        if not rows or not len(docs):
            return _table([], _REGIONS)
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        ids, tags = (np.concatenate(c) for c in zip(*heads))
        numbers = np.concatenate([unpack(r["places"]) for r in rows])
        of = by_document(ids, tags)
        batch = Batch(
            docs.column("doc_id").to_pylist(),
            docs.column("text").cast(pa.binary()).to_pylist(),
            tagged,
        )
        group, doc, starts, windows, content, doubles = [], [], [], [], [], []
        seen: dict[bytes, int] = {}
        for d, text in enumerate(batch.texts):
            own_id = int(batch.ids[d])
            at = of.get((own_id, int(batch.tags[d])))
            if at is None:
                continue
            found = anchored_suffixes([text], window)
            where = np.unique(numbers[at])
            hot = np.isin(found.anchor[where], above)
            own_groups = groups.of(found.code[where], found.anchor[where])
            columns = (found.start[where], found.windows[where], own_groups, hot)
            words = text.split()
            for start, n, g, many in zip(*(c.tolist() for c in columns)):
                for i, m in [(start + k, 1) for k in range(n)] if many else [(start, n)]:
                    piece = b" ".join(words[i : i + m + window - 1])
                    # Documents come by id, so the first one seen is the smallest.
                    if own_id > seen.setdefault(xxhash.xxh128_digest(piece), own_id):
                        doubles.append((d, i, m + window - 1))
                        continue
                    group.append(xxhash.xxh64_intdigest(piece) % groups.total if many else g)
                    doc.append(d)
                    starts.append(i)
                    windows.append(m)
                    content.append(piece)
        group, doc, starts, windows = (np.array(x, np.int64) for x in (group, doc, starts, windows))
        packer = zstandard.ZstdCompressor(1)
        out = []
        for key, p in _parts(group):
            out.append([
                key, *doc_headers(batch.ids[doc[p]], batch.tags[doc[p]]), pack(starts[p]),
                pack(windows[p]), packer.compress(b"\n".join([content[i] for i in p])),
            ])
        if doubles:
            doc, starts, lengths = (np.array(c, np.int64) for c in zip(*doubles))
            for block, p in _parts(block_numbers(batch.ids[doc], n_blocks)):
                out.append([
                    -1 - block, *doc_headers(batch.ids[doc[p]], batch.tags[doc[p]]),
                    pack(starts[p]), pack(lengths[p]), b"",
                ])
        return _table(out, _REGIONS)

    return run


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Numbers from 1 that order as the words do; equal for equal words only."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    by = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(by), np.int64)
    number[by] = np.arange(1, len(by) + 1)
    return number[coded.indices.to_numpy()]


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of a text of numbers in the order of what follows, ``depth`` numbers at least."""
    rank, known = text, 1
    while known < depth:
        ahead = np.append(rank[known:], np.zeros(min(known, len(rank)), rank.dtype))
        rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)[1] + 1
        known *= 2
    return np.argsort(rank, kind="stable")


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """How many numbers each suffix shares with the one before it in order, up to ``depth``;
    none for the first. Zeros end a text and equal nothing."""
    shared = np.zeros(len(order), np.int64)
    pair = np.arange(1, len(order))
    for known in range(depth):
        a, b = order[pair - 1] + known, order[pair] + known
        inside = np.maximum(a, b) < len(text)
        pair, a, b = pair[inside], a[inside], b[inside]
        pair = pair[(text[a] == text[b]) & (text[a] > 0)]
        shared[pair] += 1
    return shared


def repeated_windows(pieces: list[bytes], low: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """``piece, place`` of the windows that also stand in a piece of a smaller ``low``.

    The pieces' words are one text with a zero after each piece. Deep intervals of the sorted
    suffixes are the internal nodes of their tree; the least ``low`` of a node stays.
    """
    sizes = np.array([p.count(b" ") + 1 for p in pieces], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, np.int64)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner] = word_numbers(b" ".join(pieces).split(b" "))
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    order = sorted_suffixes(text, window)
    deep = common_prefixes(text, order, window) >= window
    # A node of the tree: suffixes of which all but the first share a window with the one before.
    begin = np.flatnonzero(~deep)
    least = np.minimum.reduceat(low[owner[order]], begin)
    least = np.repeat(least, np.diff(np.append(begin, len(order))))
    gone = np.sort(order[low[owner[order]] > least])
    return owner[gone], gone - (ends - sizes)[owner[gone]]


def _trees(window: int, n_blocks: int):
    """Words to remove, from the regions of one group; back to their blocks, as ``_MARKS``."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        key = rows[0]["grp"]
        if key < 0:  # settled before
            columns = ("ids", "tags", "counts", "places", "windows")
            return _table([[-1 - key, *(r[c] for c in columns)] for r in rows], _MARKS)
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        ids, tags = (np.concatenate(c) for c in zip(*heads))
        starts = np.concatenate([unpack(r["places"]) for r in rows])
        windows = np.concatenate([unpack(r["windows"]) for r in rows])
        unpacker = zstandard.ZstdDecompressor()
        content = b"\n".join(unpacker.decompress(r["content"]) for r in rows).split(b"\n")
        number: dict[bytes, int] = {}
        piece = np.array([number.setdefault(c, len(number)) for c in content], np.int64)
        del content
        low = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(low, piece, ids)
        of, place = repeated_windows(list(number), low, window)
        # Regions equal to one of a smaller document go as a whole; of the smallest document's
        # go the neighbouring windows that a smaller one has elsewhere.
        whole = np.flatnonzero(ids > low[piece])
        own = np.flatnonzero(ids == low[piece])
        head = np.flatnonzero(
            np.append(True, (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)) if len(of) else []
        )
        tail = np.append(head, len(of))[1:] - 1
        span_of, span_at = of[head], place[head]
        span_size = place[tail] - place[head] + window
        first = np.searchsorted(span_of, piece[own], "left")
        count = np.searchsorted(span_of, piece[own], "right") - first
        leaf = np.repeat(own, count)
        span = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        doc = np.concatenate([whole, leaf])
        begin = np.concatenate([starts[whole], starts[leaf] + span_at[span]])
        size = np.concatenate([windows[whole] + window - 1, span_size[span]])
        by = np.lexsort((begin, tags[doc], ids[doc]))
        doc, begin, size = doc[by], begin[by], size[by]
        out = [
            [block, *doc_headers(ids[doc[p]], tags[doc[p]]), pack(begin[p]), pack(size[p])]
            for block, p in _parts(block_numbers(ids[doc], n_blocks))
        ]
        return _table(out, _MARKS)

    return run


def _answer(with_text: bool, tagged: bool):
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        rows = marks.to_pylist()
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        empty = np.zeros(0, np.int64)
        ids, tags = (np.concatenate(c) for c in zip(*heads)) if rows else (empty, empty)
        places = np.concatenate([unpack(r["places"]) for r in rows]) if rows else empty
        lengths = np.concatenate([unpack(r["lengths"]) for r in rows]) if rows else empty
        of = by_document(ids, tags)
        batch = Batch(
            docs.column("doc_id").to_pylist(),
            docs.column("text").cast(pa.binary()).to_pylist(),
            tagged,
        )
        out = []
        for doc_id, tag, text in zip(batch.ids, batch.tags, batch.texts):
            words = text.split()
            at = of.get((int(doc_id), int(tag)))
            removed, kept = 0, words
            if at is not None:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, places[at], 1)
                np.add.at(edge, places[at] + lengths[at], -1)
                stays = np.cumsum(edge[:-1]) == 0
                removed = len(words) - int(stays.sum())
                kept = list(compress(words, stays.tolist()))
            rest = b" ".join(kept)
            digest = hashlib.sha256(rest).hexdigest()
            own = None if doc_id == NULL_ID else int(doc_id)
            out.append((own, len(words), removed, digest, rest if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        columns[4] = columns[4].cast(pa.string())
        return pa.table(columns, names)

    return run


def drop_passages(
    docs: DataFrame,
    window: int = WINDOW,
    with_text: bool = True,
    group_suffixes: int = GROUP_SUFFIXES,
    hot: int = HOT,
) -> DataFrame:
    """A row per document: ``doc_id, n_words, n_removed, kept_sha256, kept_text``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = texts.select("text").mapInArrow(_count(window), "code bigint, n bigint")
    counts = np.zeros(DIGIT * DIGIT, np.int64)
    for row in counted.groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[row.code] = row.n
    groups = Groups(*prefix_groups(counts, group_suffixes))
    n_blocks = max(1, -(-text_bytes(docs) // BLOCK_BYTES))
    tagged = ids_repeat(docs)

    sent = texts.mapInArrow(_send_hashes(window, groups, n_blocks, tagged), _SENT)
    folder = scratch_path(spark, "passages")
    (
        sent.repartition(groups.total + n_blocks, "grp")
        .groupBy("grp")
        .applyInArrow(_known_anchors(n_blocks, hot), _KNOWN)
        .write.parquet(f"{folder}/known")
    )
    known = spark.read.parquet(f"{folder}/known")
    # At most one anchor for every ``hot`` places.
    lists = known.where(F.col("block") == _HOT_BLOCK).select("hot").collect()
    above = np.sort(np.concatenate([np.zeros(0, _U), *(np.frombuffer(r.hot, _U) for r in lists)]))
    known = known.where(F.col("block") != _HOT_BLOCK)
    rows = texts.withColumn("block", block_column(n_blocks))
    regions = (
        rows.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(_regions(window, groups, n_blocks, above, tagged), _REGIONS)
    )
    marks = (
        regions.repartition(groups.total + n_blocks, "grp")
        .groupBy("grp")
        .applyInArrow(_trees(window, n_blocks), _MARKS)
    )
    return (
        rows.groupBy("block")
        .cogroup(marks.groupBy("block"))
        .applyInArrow(
            _answer(with_text, tagged),
            "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
            "kept_text string",
        )
    )
