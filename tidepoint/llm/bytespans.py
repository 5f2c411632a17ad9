"""Repeated byte strings, by interval expansion on Burrows-Wheeler transforms.

A string of ``length`` bytes that occurs twice has the same anchor in both places: the least
hash of its ``GRAM``-byte substrings. Anchors that occur once in the corpus are found first
and never looked at again. Around every other anchor lies a region, all strings of ``length``
bytes that have it as their anchor, and regions of one anchor are gathered in one group.

A group's distinct regions are joined into a text, whose suffixes are sorted to give its
Burrows-Wheeler transform. Starting from the single interval of all suffixes, intervals are
expanded breadth first: extending by a byte to the left maps the suffixes by the transform,
and those that come from different intervals of common prefix n have a common prefix of
n + 1 at most. So common prefixes are found in the order of their length, and the expansion
stops at ``length``. What is then still in one interval is one string. The first occurrence
of each string in the corpus stays, every other one is removed.

Neighbouring regions of one text that are equal, as in a stretch of one repeated byte, are a
train of a few numbers, so a run of many megabytes takes no more room than its bytes.
Equal regions share one copy of their text, and before regions move, each task keeps only
its first occurrence of each; the others are removed as a whole. Regions around an anchor that
occurs in very many places are cut into their single strings, which spread over all groups.
An anchor's places are counted over the whole corpus, so all its regions go the same way. The
list of such anchors reaches every task; it has at most one entry for ``HOT`` places.

Defined cases: null, empty and short texts lose nothing; strings never cross documents; rows
that share an id count as one document, and an occurrence that starts where another row with
the same id has it stays; a null id orders before every other id; an empty table gives no
rows. A cut through a character leaves its remaining bytes. Columns besides ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
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
from tidepoint.llm.words import byte_coefficients, mix, powers, prefix_sums
from tidepoint.session import scratch_path

LENGTH = 100
GRAM = 24
BATCH_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
GROUP_ANCHORS = 500_000
GROUP_BYTES = 3 << 20
SLICE = 1 << 20  # strings of a text that are worked on at a time; a multiple of 65,536
HOT = 20_000  # places of an anchor in the whole corpus

_U = np.uint64
_TOP = _U(2**64 - 1)
_LOW = _U(0xFFFF)
_SENT = "grp bigint, ids binary, tags binary, counts binary, hashes binary, places binary"
_KNOWN = "block bigint, ids binary, tags binary, counts binary, places binary, hot binary"
_HOT_BLOCK = -1  # of the rows that have the anchors above HOT, in place of places
_REGIONS = (
    "grp bigint, ids binary, tags binary, counts binary, starts binary, lengths binary, "
    "content binary"
)
_SPANS = "block bigint, ids binary, tags binary, counts binary, starts binary, lengths binary"


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _table(rows: list[list], schema: str) -> pa.Table:
    names = _names(schema)
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.int64(), *[pa.binary()] * (len(names) - 1)]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _parts(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Indices of the entries of each key, in their order."""
    order = np.argsort(keys, kind="stable")
    begin = runs(keys[order])
    for a, b in zip(begin, np.append(begin[1:], len(order))):
        yield int(keys[order[a]]), order[a:b]


def anchors(
    text: bytes, length: int, gram: int, whole: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each run of strings that share it, and where the runs begin.

    ``whole``: with the low bits of the anchor's place below the bits of its hash.
    """
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    sums = prefix_sums(byte_coefficients(np.frombuffer(text, np.uint8)))
    _, down = powers(len(text))
    hashes = mix((sums[gram:] - sums[:-gram]) * down[: len(text) - gram + 1])
    # The low bits are the place, so that of equal hashes the leftmost counts: a run ends
    # where the anchor moves on, also to a repeat of itself.
    places = np.arange(len(hashes)).astype(_U) & _LOW
    hashes = (hashes & ~_LOW) | places
    # Sliding minimum: each window is a suffix of one block and a prefix of the next.
    width = length - gram + 1
    padded = np.append(hashes, np.full(-len(hashes) % width, _TOP)).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    # Windows across a multiple of 65,536: there the low bits count from the first window.
    for edge in range(1 << 16, len(hashes), 1 << 16):
        a, b = edge - width + 1, min(edge + width - 1, len(hashes))
        near = (hashes[a:b] & ~_LOW) | np.arange(b - a).astype(_U)
        near = np.lib.stride_tricks.sliding_window_view(near, width).min(axis=1)
        least[a : a + len(near)] = hashes[a + (near & _LOW).astype(np.int64)]
    begin = runs(least)
    return (least[begin] if whole else least[begin] >> _U(16)), begin


class Trains(NamedTuple):
    """Neighbouring runs of one text with equal anchors and equal lengths, as arrays.

    Train ``i`` has ``count[i]`` runs, which begin at ``first[i]`` and each ``step[i]`` further;
    a run's region is its ``step`` strings. A stretch of one repeated byte is a single train,
    however long.
    """

    anchor: np.ndarray
    first: np.ndarray
    step: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, text: bytes, length: int, gram: int) -> Trains:
        """Long texts are worked on in slices, which begin at multiples of 65,536."""
        n = len(text) - length + 1
        parts, last = [], None
        for begin in range(0, max(n, 0), SLICE):
            anchor, at = anchors(text[begin : begin + SLICE + length - 1], length, gram, whole=True)
            joins = last is not None and anchor[0] == last
            last = anchor[-1]
            parts.append(cls._trains(anchor >> _U(16), at + begin, min(begin + SLICE, n), joins))
        if not parts:
            none = np.zeros(0, np.int64)
            return cls(np.zeros(0, _U), none, none, none)
        if len(parts) == 1:
            return cls(*parts[0][:4])
        return cls._joined(parts)

    @classmethod
    def _trains(cls, anchor, first, end: int, joins: bool):
        """Trains of one slice, and whether its first run goes on from the slice before."""
        step = np.diff(np.append(first, end))
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (step[1:] != step[:-1]))
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(anchor)))
        return anchor[head], first[head], step[head], count, joins

    @classmethod
    def _joined(cls, parts) -> Trains:
        """Slices put together: a run across an edge is one run."""
        rows: list[list[np.ndarray]] = []
        for anchor, first, step, count, joins in parts:
            columns = [anchor, first, step, count]
            if joins:
                before = [c[-1] for c in rows[-1]]
                rest = before[3] - 1  # runs of the last train but its last
                own = before[1] + rest * before[2]  # where the joined run begins
                size = before[2] + step[0]
                rows[-1] = [c[:-1] for c in rows[-1]]  # may be empty, and stays behind the next
                if rest:
                    rows.append([np.array([v]) for v in (before[0], before[1], before[2], rest)])
                rows.append([np.array([v]) for v in (before[0], own, size, 1)])
                if count[0] > 1:
                    more = (anchor[0], first[0] + step[0], step[0], count[0] - 1)
                    rows.append([np.array([v]) for v in more])
                columns = [c[1:] for c in columns]
            if len(columns[0]):
                rows.append(columns)
        joined = [np.concatenate(c) for c in zip(*rows)]
        kinds = (_U, np.int64, np.int64, np.int64)
        return cls(*(c.astype(k) for c, k in zip(joined, kinds)))


def _batch_anchors(texts: list[bytes], length: int, gram: int):
    """``document, place, anchor, count`` of all trains; the place is the train's number in its
    text, the count that of its runs."""
    found = [Trains.of(t, length, gram) for t in texts]
    sizes = np.array([len(f.anchor) for f in found], np.int64)
    docs = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(len(docs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    anchor = np.concatenate([np.zeros(0, _U), *(f.anchor for f in found)])
    return docs, places, anchor, np.concatenate([np.zeros(0, np.int64), *(f.count for f in found)])


def _send_anchors(length: int, gram: int, n_groups: int, n_blocks: int, tagged: bool = True):
    """Anchors to their groups. Those that a batch has twice are known to repeat already:
    they go back under -1 - block, and their group hears of them once, without a place but
    with the number of their places."""

    def settle(batch: Batch) -> Iterator[list]:
        docs, places, anchor, count = _batch_anchors(batch.texts, length, gram)
        if not len(docs):
            return
        order = np.argsort(anchor, kind="stable")
        begin = runs(anchor[order])
        sizes = np.add.reduceat(count[order], begin)
        twice = np.zeros(len(order), bool)
        twice[order] = np.repeat(sizes > 1, np.diff(np.append(begin, len(order))))
        at = np.flatnonzero(twice)
        for block, part in _parts(block_numbers(batch.ids[docs[at]], n_blocks)):
            own = at[part]
            yield [
                -1 - block, *doc_headers(batch.ids[docs[own]], batch.tags[docs[own]]),
                b"", pack(places[own]),
            ]
        at = np.flatnonzero(~twice)
        single = np.full(0, 0, np.int64)
        for key, part in _parts(spread(anchor[at], n_groups)):
            own = at[part]
            yield [
                key, *doc_headers(batch.ids[docs[own]], batch.tags[docs[own]]),
                anchor[own].tobytes(), pack(places[own]),
            ]
        heads, many = anchor[order[begin[sizes > 1]]], sizes[sizes > 1]
        for key, part in _parts(spread(heads, n_groups)):
            yield [key, *doc_headers(single, single), heads[part].tobytes(), pack(many[part])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in document_batches(batches, BATCH_BYTES, tagged):
            yield from _table(list(settle(batch)), _SENT).to_batches()

    return run


def _known_anchors(n_blocks: int, hot: int):
    """Which places have an anchor that repeats, from one group; back to their blocks. And
    the group's anchors that have more than ``hot`` places in all batches together."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        key = rows[0]["grp"]
        if key < 0:
            out = [[-1 - key, r["ids"], r["tags"], r["counts"], r["places"], b""] for r in rows]
            return _table(out, _KNOWN)
        placed = [r for r in rows if r["ids"]]
        others = [r for r in rows if not r["ids"]]
        none = np.zeros(0, np.int64)
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in placed]
        ids, tags = (np.concatenate(c) for c in zip(*heads)) if placed else (none, none)
        places = np.concatenate([unpack(r["places"]) for r in placed] or [none])
        many = np.concatenate([unpack(r["places"]) for r in others] or [none])
        own = np.append(np.ones(len(places), np.int64), many)  # places behind each entry
        anchor = np.concatenate(
            [np.frombuffer(r["hashes"], _U) for r in placed + others] or [np.zeros(0, _U)]
        )
        order = np.argsort(anchor, kind="stable")
        begin = runs(anchor[order])
        sizes = np.diff(np.append(begin, len(order)))
        totals = np.add.reduceat(own[order], begin)
        count = np.zeros(len(order), np.int64)
        count[order] = np.repeat(totals, sizes)
        count = count[: len(places)]  # what has a place comes first
        gone = np.flatnonzero(count > 1)
        gone = gone[np.lexsort((places[gone], tags[gone], ids[gone]))]
        out = [
            [
                block, *doc_headers(ids[gone[p]], tags[gone[p]]), pack(places[gone[p]]), b"",
            ]
            for block, p in _parts(block_numbers(ids[gone], n_blocks))
        ]
        above = anchor[order[begin[totals > hot]]]
        if len(above):
            out.append([_HOT_BLOCK, *doc_headers(none, none), b"", above.tobytes()])
        return _table(out, _KNOWN)

    return run


def _periodic(text: bytes, begin: int, step: int, count: int, length: int) -> bool:
    """Whether the regions of a train are all equal: their stretch repeats itself by its step."""
    end = begin + step * count + length - 1
    view = np.frombuffer(text, np.uint8)
    return all(
        (view[i : min(i + SLICE, end - step)] == view[i + step : min(i + SLICE, end - step) + step]).all()
        for i in range(begin, end - step, SLICE)
    )


def _regions(
    length: int, gram: int, n_groups: int, n_blocks: int, above: np.ndarray, tagged: bool = True
):
    """Regions of the repeated anchors of one block, to the groups of their anchors.

    ``above``: the anchors with very many places, sorted.
    """

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        rows = known.to_pylist()
        if not rows or not len(docs):
            return _table([], _REGIONS)
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        ids, tags = (np.concatenate(c) for c in zip(*heads))
        places = np.concatenate([unpack(r["places"]) for r in rows])
        of = by_document(ids, tags)
        batch = Batch(
            docs.column("doc_id").to_pylist(),
            docs.column("text").cast(pa.binary()).to_pylist(),
            tagged,
        )
        group, doc, starts, content, doubles = [], [], [], [], []
        seen: dict[bytes, tuple[int, int, int]] = {}
        for d, text in enumerate(batch.texts):
            at = of.get((int(batch.ids[d]), int(batch.tags[d])))
            if at is None:
                continue
            trains = Trains.of(text, length, gram)
            order = at[np.argsort(places[at], kind="stable")]
            where = places[order]
            own_groups = spread(trains.anchor[where], n_groups)
            hot = np.zeros(len(where), bool)
            if len(above):
                near = np.minimum(np.searchsorted(above, trains.anchor[where]), len(above) - 1)
                hot = above[near] == trains.anchor[where]
            for p, g, many in zip(where.tolist(), own_groups.tolist(), hot.tolist()):
                begin, step, count = trains.first[p], trains.step[p], trains.count[p]
                begin, step, count = int(begin), int(step), int(count)
                starts_here = range(begin, begin + step * count, step)
                if count > 1 and _periodic(text, begin, step, count, length):
                    # Every region is the first one again: one span removes all the others.
                    doubles.append((d, begin + step, step * (count - 1) + length - 1))
                    starts_here = starts_here[:1]
                if many:
                    cuts = [(i, i + length) for a in starts_here for i in range(a, a + step)]
                else:
                    cuts = [(a, a + step + length - 1) for a in starts_here]
                for i, j in cuts:
                    piece = text[i:j]
                    to = xxhash.xxh64_intdigest(piece) % n_groups if many else g
                    mark = xxhash.xxh128_digest(piece)
                    # Documents come by id and places in order: the first one seen stays.
                    own = (int(batch.ids[d]), i, int(batch.tags[d]))
                    first = seen.setdefault(mark, own)
                    if own[:2] > first[:2]:
                        doubles.append((d, i, j - i))
                        continue
                    if first is not own and own == first:  # a copy of the row
                        continue
                    group.append(to)
                    doc.append(d)
                    starts.append(i)
                    content.append(piece)
        group, doc, starts = (np.array(x, np.int64) for x in (group, doc, starts))
        lengths = np.array([len(c) for c in content], np.int64)
        packer = zstandard.ZstdCompressor(1)
        out = []
        for key, p in _parts(group):
            out.append([
                key, *doc_headers(batch.ids[doc[p]], batch.tags[doc[p]]), pack(starts[p]),
                pack(lengths[p]), packer.compress(b"".join(content[i] for i in p)),
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


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least, by doubling.

    A rank is the first place of the suffixes that are alike so far. Only those that share
    theirs are sorted further.
    """
    n = len(text)
    padded = np.append(text, np.zeros(8, np.uint8)).astype(_U)
    key = np.zeros(n, _U)
    for i in range(8):
        key = (key << _U(8)) | padded[i : n + i]
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    place = np.arange(n, dtype=np.int32)
    rank = np.empty(n + 1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    known = 8
    while known < depth:
        shared = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(shared):
            break
        suffix = order[shared]
        rank[n] = -1  # nothing follows
        ahead = rank[np.minimum(suffix + known, n)] + 1
        key = (rank[suffix].astype(_U) << _U(32)) | ahead.astype(_U)
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[shared] = suffix
        fresh = np.append(True, key[1:] != key[:-1])
        new[shared] = fresh
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(shared)), 0))
        rank[suffix] = shared[first]
        known *= 2
    return order


def string_classes(
    text: np.ndarray, ends: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes and the number of the interval of common prefix ``depth`` of each.

    The text is of pieces, each with a zero byte at its end. Intervals are expanded from the transform
    by one byte to the left at a time, all at once; only suffixes whose common prefix with
    their neighbour is still open take part, and none longer than to the end of its piece.
    """
    n = len(text)
    order = np.append(np.int32(n), sort_suffixes(text, depth))  # the empty suffix comes first
    symbols = np.append(text.astype(np.uint16) + np.uint16(1), np.uint16(0))
    transform = symbols[order - 1]  # what stands before each suffix; the text is a ring
    # The suffixes that begin with a symbol keep the order of their rests.
    onward = np.argsort(transform, kind="stable").astype(np.int32)
    first = symbols[order]
    new = np.append(True, first[1:] != first[:-1])
    open_ = np.flatnonzero(~new).astype(np.int32)
    left, right = onward[open_ - 1], onward[open_]
    size = np.diff(ends, prepend=-1)
    rest = np.append(np.repeat(ends, size) - np.arange(n), 0)
    rest = np.minimum(rest, depth).astype(np.uint8 if depth < 256 else np.int32)[order]
    reach = np.maximum(rest[open_ - 1], rest[open_])
    for known in range(1, depth):
        interval = np.cumsum(new, dtype=np.int32)
        differ = interval[left] != interval[right]
        if not differ.any():  # an interval is only divided by one that was a round before
            break
        new[open_[differ]] = True
        stay = ~differ & (reach > known)
        open_, left, right, reach = open_[stay], left[stay], right[stay], reach[stay]
    return order[1:], np.cumsum(new)[1:]


def _expand(length: int, n_blocks: int):
    """Spans to remove, from the regions of one group; back to their blocks."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        key = rows[0]["grp"]
        if key < 0:
            out = [[-1 - key, *(r[c] for c in _names(_SPANS)[1:])] for r in rows]
            return _table(out, _SPANS)
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        ids, tags = (np.concatenate(c) for c in zip(*heads))
        starts = np.concatenate([unpack(r["starts"]) for r in rows])
        lengths = np.concatenate([unpack(r["lengths"]) for r in rows])
        unpacker = zstandard.ZstdDecompressor()
        data = b"".join(unpacker.decompress(r["content"]) for r in rows)
        ends = np.cumsum(lengths)
        # The first occurrence of each region carries its text.
        order = np.lexsort((starts, ids))
        firsts: dict[bytes, int] = {}
        carrier, twins = [], []
        gone_doc, gone_start, gone_length = [], [], []
        for i in order.tolist():
            piece = data[ends[i] - lengths[i] : ends[i]]
            first = firsts.setdefault(piece, i)
            if first == i:
                carrier.append(i)
            elif (ids[i], starts[i]) > (ids[first], starts[first]):
                gone_doc.append(i)
                gone_start.append(starts[i])
                gone_length.append(lengths[i])
            else:  # the same place in another row with the same id
                twins.append((i, first))
        carrier = np.array(carrier)
        text = np.frombuffer(b"\0".join(firsts) + b"\0", np.uint8)
        del data
        sizes = lengths[carrier]
        begin = np.cumsum(sizes + 1) - sizes - 1
        strings = sizes - length + 1
        owner = np.repeat(np.arange(len(carrier)), strings)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
        at = begin[owner] + inner  # where strings begin in the text
        suffix, number = string_classes(text, begin + sizes, length)
        of_text = np.empty(len(text), np.int64)
        of_text[suffix] = number
        cls = of_text[at]
        who, where = ids[carrier[owner]], starts[carrier[owner]] + inner
        by = np.lexsort((where, who, cls))
        heads_at = runs(cls[by])
        repeat = np.diff(np.append(heads_at, len(by)))
        low_id = np.repeat(who[by[heads_at]], repeat)
        low_at = np.repeat(where[by[heads_at]], repeat)
        later = np.zeros(len(by), bool)
        later[by] = (who[by] > low_id) | (where[by] > low_at)
        spot = np.flatnonzero(later)
        if len(spot):  # neighbouring strings of one region make one span
            cut = np.append(True, (np.diff(spot) > 1) | (owner[spot[1:]] != owner[spot[:-1]]))
            head = np.flatnonzero(cut)
            tail = np.append(head[1:], len(spot)) - 1
            found = list(
                zip(
                    carrier[owner[spot[head]]].tolist(),
                    where[spot[head]].tolist(),
                    (inner[spot[tail]] - inner[spot[head]] + length).tolist(),
                )
            )
            for i, first in twins:
                found += [(i, at, size) for doc, at, size in found if doc == first]
            for columns, values in zip((gone_doc, gone_start, gone_length), zip(*found)):
                columns += values
        doc, start, span = (np.array(x, np.int64) for x in (gone_doc, gone_start, gone_length))
        by = np.lexsort((start, tags[doc], ids[doc])) if len(doc) else doc
        doc, start, span = doc[by], start[by], span[by]
        out = [
            [block, *doc_headers(ids[doc[p]], tags[doc[p]]), pack(start[p]), pack(span[p])]
            for block, p in _parts(block_numbers(ids[doc], n_blocks))
        ]
        return _table(out, _SPANS)

    return run


def _answer(with_text: bool, tagged: bool = True):
    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        rows = spans.to_pylist()
        heads = [expand_headers(r["ids"], r["tags"], r["counts"]) for r in rows]
        empty = np.zeros(0, np.int64)
        ids, tags = (np.concatenate(c) for c in zip(*heads)) if rows else (empty, empty)
        starts = np.concatenate([unpack(r["starts"]) for r in rows]) if rows else empty
        sizes = np.concatenate([unpack(r["lengths"]) for r in rows]) if rows else empty
        of = by_document(ids, tags)
        batch = Batch(
            docs.column("doc_id").to_pylist(),
            docs.column("text").cast(pa.binary()).to_pylist(),
            tagged,
        )
        out = []
        for doc_id, tag, text in zip(batch.ids, batch.tags, batch.texts):
            at = of.get((int(doc_id), int(tag)))
            removed = n_spans = 0
            kept = text
            if at is not None:
                by = np.argsort(starts[at], kind="stable")
                begin = starts[at][by]
                end = np.maximum.accumulate(begin + sizes[at][by])
                first = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
                begin, end = begin[first], end[np.append(first[1:], len(end)) - 1]
                removed, n_spans = int((end - begin).sum()), len(begin)
                stays = zip([0, *end.tolist()], [*begin.tolist(), len(text)])
                kept = b"".join([text[a:b] for a, b in stays])
            own = None if doc_id == NULL_ID else int(doc_id)
            digest = hashlib.sha256(kept).hexdigest()
            out.append((own, len(text), removed, n_spans, digest, kept if with_text else None))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True
) -> DataFrame:
    """A row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size, tagged = text_bytes(docs), ids_repeat(docs)
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    n_anchor_groups = max(1, -(-size // (GROUP_ANCHORS * (length - gram) // 2)))
    sent = texts.mapInArrow(_send_anchors(length, gram, n_anchor_groups, n_blocks, tagged), _SENT)
    folder = scratch_path(spark, "bytespans")
    (
        sent.repartition(n_anchor_groups + n_blocks, "grp")
        .groupBy("grp")
        .applyInArrow(_known_anchors(n_blocks, HOT), _KNOWN)
        .write.parquet(f"{folder}/known")
    )
    known = spark.read.parquet(f"{folder}/known")
    lists = known.where(F.col("block") == _HOT_BLOCK).select("hot").collect()
    above = np.sort(np.concatenate([np.zeros(0, _U), *(np.frombuffer(r.hot, _U) for r in lists)]))
    known = known.where(F.col("block") != _HOT_BLOCK)
    # A place takes one byte at least, so this bounds the bytes of the regions from above.
    places = known.agg(F.sum(F.octet_length("places")).alias("n")).first().n or 0
    n_groups = max(1, -(-places * (length + length // 2) // 2 // GROUP_BYTES))
    rows = texts.withColumn("block", block_column(n_blocks))
    regions = (
        rows.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(_regions(length, gram, n_groups, n_blocks, above, tagged), _REGIONS)
    )
    spans = (
        regions.repartition(n_groups + n_blocks, "grp")
        .groupBy("grp")
        .applyInArrow(_expand(length, n_blocks), _SPANS)
    )
    return (
        rows.groupBy("block")
        .cogroup(spans.groupBy("block"))
        .applyInArrow(
            _answer(with_text, tagged),
            "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
            "kept_sha256 string, kept binary",
        )
    )
