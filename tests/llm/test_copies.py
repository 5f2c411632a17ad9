"""Exact and near copies, repeated passages and strings, against plain versions."""

import os
import random
import sys
from collections import Counter

import pytest
from brute import (
    CASES,
    case_frame,
    empty_frame,
    jaccard_components,
    without_passages,
    without_strings,
)

from tidepoint.llm import minhash
from tidepoint.llm.blocks import block_column, block_numbers, pack, unpack
from tidepoint.llm.bytespans import anchors, drop_repeats, string_classes
from tidepoint.llm.components import components
from tidepoint.llm.exact import drop_copies, exact_copies
from tidepoint.llm.minhash import drop_near_copies, near_classes
from tidepoint.llm.passages import (
    anchored_suffixes,
    common_prefixes,
    drop_passages,
    prefix_groups,
    repeated_windows,
    sorted_suffixes,
    word_numbers,
)
from tidepoint.llm.registry import ROOT, importable

import numpy as np


def _edited(seed=3, n=60):
    """A large group of near copies, some just below the threshold, and strangers."""
    rng = random.Random(seed)
    base = [f"v{rng.randrange(400)}" for _ in range(150)]
    docs = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 12])):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        docs.append((i * 3, " ".join(own)))
    for i in range(n):
        docs.append((1000 + i, " ".join(f"v{rng.randrange(400)}" for _ in range(rng.randrange(1, 90)))))
    return docs + [(2000, None), (2001, ""), (2002, "v1"), (2003, "V1")]


def test_exact_cases(spark):
    frame = case_frame(spark)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_copies(frame).collect())
    assert sum(got.values()) == len(CASES)
    assert got[(5, 8, 3, False)] == 2 and got[(8, 8, 3, True)] == 1
    assert got[(1, 2, 2, False)] == 1 and got[(2, 2, 2, True)] == 1
    assert got[(None, None, 1, True)] == 1
    shuffled = exact_copies(frame, broadcast_groups=0)
    assert Counter(map(tuple, shuffled.collect())) == Counter(map(tuple, exact_copies(frame).collect()))
    assert exact_copies(empty_frame(spark)).count() == 0


def test_drop_copies_keeps_columns(spark):
    frame = case_frame(spark)
    kept = drop_copies(frame)
    assert kept.columns == frame.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([2, 3, 4, 6, 6, 7, 8, None, 9, 10])
    doubled = case_frame(spark, [CASES[4], CASES[4]])
    assert drop_copies(doubled).count() == 1
    assert drop_copies(empty_frame(spark)).count() == 0


def test_exact_plan_is_native(spark):
    plan = exact_copies(case_frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copies_match_all_pairs(spark):
    docs = _edited()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for n in (2, 5):
        rows = near_classes(importable(spark) and frame, words=n).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == jaccard_components(docs, n)
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def _of_one_template(n):
    """Documents that share two thirds to nine tenths of their words, in groups of copies."""
    rng = random.Random(n)
    template = [f"t{i}" for i in range(90)]
    docs = []
    while len(docs) < n:
        own = [f"d{len(docs)}w{i}" for i in range(rng.choice((8, 14, 25, 45)))]
        for _ in range(rng.choice((1, 1, 2, 4))):
            near = [w if rng.random() > 0.04 else w + "x" for w in template + own]
            docs.append((len(docs), " ".join(near)))
    return docs[:n]


def _family(spark, docs):
    sets = spark.createDataFrame(
        [(1, d, len(set(zip(t.split(), t.split()[1:]))), d) for d, t in docs],
        "k bigint, x bigint, n bigint, c bigint",
    )
    return sets, spark.createDataFrame(docs, "doc_id bigint, text string")


def test_families_dealt_by_tokens_lose_no_link(spark, monkeypatch):
    importable(spark)
    docs = _of_one_template(120)
    expected = jaccard_components(docs, 2)
    assert len({c for _, c in expected.values()}) < 100
    families, texts = _family(spark, docs)
    for limit, share in ((1_000_000, 64), (1_500, 4), (600, 64)):
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", limit)
        monkeypatch.setattr(minhash, "FREQUENT", share)
        links = [tuple(r) for r in minhash.family_links(families, texts, 2, 80).collect()]
        own = components(spark.createDataFrame(links, "a bigint, b bigint"))
        found = {r.node: r.component for r in own.collect()}
        assert {d: found.get(d, d) for d, _ in docs} == {d: c for d, (_, c) in expected.items()}


def test_family_copies_grow_with_its_members(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(minhash, "FREQUENT", 2)
    copies = []
    for n in (100, 400):
        docs = [
            (i, " ".join([f"t{k}" for k in range(70)] + [f"d{i // 2}w{k}" for k in range(40)]))
            for i in range(n)
        ]
        copies.append(minhash.dealt_families(*_family(spark, docs), 2, 80).count())
    assert 0 < copies[1] < 5 * copies[0]


def test_near_copies_cases(spark):
    frame = case_frame(importable(spark) and spark)
    rows = near_classes(frame, words=2).collect()
    assert len(rows) == len(CASES)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[8].component_id == 5 and not by_id[8].kept
    assert by_id[2].component_id == 2 and by_id[2].n_shingles == 0
    assert by_id[None].kept
    kept = drop_near_copies(frame, words=2)
    assert kept.columns == frame.columns
    assert near_classes(empty_frame(spark)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (200, 200)]
    edges = importable(spark).createDataFrame(chain, "a bigint, b bigint")
    for small in (0, 5, 1000):
        got = components(edges, small).collect()
        assert {r.node: r.component for r in got} == {
            **{i: 0 for i in range(41)}, 100: 100, 101: 100
        }


def _passages(seed=5):
    rng = random.Random(seed)
    shared = [" ".join(f"p{s}q{rng.randrange(9)}" for _ in range(30)) for s in range(4)]
    docs = []
    for i in range(40):
        parts = [" ".join(f"a{rng.randrange(50)}" for _ in range(rng.randrange(1, 40)))]
        parts += rng.sample(shared, rng.randrange(3))
        parts.append(" ".join(f"a{rng.randrange(50)}" for _ in range(5)))
        docs.append((i, "\n".join(parts)))
    return docs + [(50, "x " * 60), (51, "x " * 14), (52, docs[3][1])]


def test_passages_match_plain(spark):
    docs = _passages()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for limit, hot in ((40, 20_000), (2_000_000, 20_000), (40, 3), (2_000_000, 0)):
        options = {"group_suffixes": limit, "hot": hot}
        rows = drop_passages(importable(spark) and frame, **options).collect()
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows)
        assert got == without_passages(docs, 13)


def test_windows_that_differ_in_a_word_are_never_equal():
    """Whatever hashes bring pieces together, the tree compares words."""
    rng = random.Random(8)
    words = [b"a", b"aa", b"b", b"\xff", b"a\x00"]
    for _ in range(200):
        pieces = {
            b" ".join(rng.choices(words, k=rng.randrange(4, 9))) for _ in range(rng.randrange(1, 12))
        }
        pieces = list(pieces)
        low = np.array([rng.randrange(-3, 3) for _ in pieces])
        of, place = repeated_windows(pieces, low, 4)
        split = [p.split(b" ") for p in pieces]
        least = {}
        for p, own in enumerate(split):
            for i in range(len(own) - 3):
                key = tuple(own[i : i + 4])
                least[key] = min(least.get(key, 9), low[p])
        assert list(zip(of.tolist(), place.tolist())) == [
            (p, i)
            for p, own in enumerate(split)
            for i in range(len(own) - 3)
            if low[p] > least[tuple(own[i : i + 4])]
        ]


def test_suffixes_in_lexical_order_with_common_prefixes():
    rng = random.Random(9)
    words = [rng.choice([b"x", b"xy", b"z"]) for _ in range(300)]
    text = word_numbers(words)
    order = sorted_suffixes(text, 300)
    assert [words[i:] for i in order] == sorted(words[i:] for i in range(300))
    shared = common_prefixes(text, order, 13)
    for k in range(1, 300):
        a, b = words[order[k - 1] :], words[order[k] :]
        same = next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
        assert shared[k] == min(same, 13)


def test_anchored_regions_cover_every_window_once():
    rng = random.Random(10)
    texts = [b" ".join(rng.choices([b"a", b"b", b"c", b"d"], k=k)) for k in (0, 12, 13, 60, 500)]
    found = anchored_suffixes(texts, 13)
    seen = Counter(
        (d, s + i)
        for d, s, n in zip(found.doc.tolist(), found.start.tolist(), found.windows.tolist())
        for i in range(n)
    )
    assert seen == Counter((d, i) for d, k in enumerate((0, 12, 13, 60, 500)) for i in range(k - 12))
    for d, text in enumerate(texts):  # and the same when a text is looked at alone
        alone = anchored_suffixes([text], 13)
        mine = found.doc == d
        for a, b in zip(alone[1:], found[1:]):
            assert (a == b[mine]).all()


def test_passages_cases(spark):
    rows = drop_passages(case_frame(importable(spark) and spark)).collect()
    plain = [(-(2**63) if d is None else d, t) for d, t, _ in CASES]
    want = Counter(
        (None if k[0] == -(2**63) else k[0], *k[1:]) for k in without_passages(plain, 13).elements()
    )
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == want
    assert drop_passages(empty_frame(spark)).count() == 0


def test_prefix_groups_hold_all():
    first, parts, n = prefix_groups(np.array([5, 3, 0, 100, 2, 2]), 10)
    assert list(first) == [0, 0, 0, 1, 11, 11] and list(parts) == [1, 1, 1, 10, 1, 1] and n == 12


def test_strings_match_plain(spark):
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefgh ") for _ in range(260))
    docs = []
    for i in range(40):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 400)))
        at = rng.randrange(100)
        docs.append((i, own + (common[at : at + rng.randrange(80, 200)] if i % 2 else "") + "é" * (i % 7)))
    docs += [(60, "a" * 1000), (61, "ab" * 300), (62, "ab" * 300), (63, docs[1][1]), (64, "\0" * 150),
             (65, "ab\0c" * 60), (66, "zz" + "ab\0c" * 40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = drop_repeats(importable(spark) and frame).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == without_strings(docs, 100)


def test_strings_cases(spark):
    rows = drop_repeats(case_frame(importable(spark) and spark)).collect()
    plain = [(-(2**63) if d is None else d, t) for d, t, _ in CASES]
    want = Counter(
        (None if k[0] == -(2**63) else k[0], *k[1:]) for k in without_strings(plain, 100).elements()
    )
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == want
    assert drop_repeats(empty_frame(spark)).count() == 0


def test_hot_anchors_give_the_same(spark, monkeypatch):
    import tidepoint.llm.bytespans as module

    monkeypatch.setattr(module, "HOT", 1)
    docs = [(i, "x%d " % i + "the same long passage in each of them, " * 3 + "end %d" % i) for i in range(30)]
    batch = module.Batch([d for d, _ in docs], [t.encode() for _, t in docs])
    sent = list(module._send_anchors(100, 24, 3, 1)(iter([_arrow(docs)])))
    assert sent and len(batch.ids) == 30
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = drop_repeats(importable(spark) and frame).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == without_strings(docs, 100)


def test_hot_is_decided_over_all_batches(spark, monkeypatch):
    import tidepoint.llm.bytespans as module

    monkeypatch.setattr(module, "GROUP_BYTES", 1000)
    monkeypatch.setattr(module, "BLOCK_BYTES", 100)
    docs = [(1, "-" * 1500 + " x"), (2, "y " + "-" * 300), (3, "z " + "-" * 130)]
    docs += [(10 + i, f"{i} " * 30 + "=" * 140) for i in range(6)]
    parts = [spark.createDataFrame([d], "doc_id bigint, text string") for d in docs]
    frame = importable(spark) and parts[0]
    for part in parts[1:]:
        frame = frame.union(part)  # a task for each document, thus a batch
    for hot in (50, 500):
        monkeypatch.setattr(module, "HOT", hot)
        rows = drop_repeats(frame).collect()
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
        assert got == without_strings(docs, 100)


def _trains_as_runs(text, length=100, gram=24):
    from tidepoint.llm.bytespans import Trains

    t = Trains.of(text, length, gram)
    return [
        (a, f + s * i, s)
        for a, f, s, c in zip(*(x.tolist() for x in t))
        for i in range(c)
    ]


@pytest.mark.parametrize("size", [1 << 16, 1 << 17])
def test_trains_are_the_runs(monkeypatch, size):
    import tidepoint.llm.bytespans as module

    rng = random.Random(8)
    noise = "".join(rng.choice("abcde fgh") for _ in range(90_000))
    texts = [noise, "-" * 200_000, noise + "=" * 120_000 + noise[:50_000], "ab" * 70_000 + noise,
             "-" * 100, "x" * 99, "", noise[:65_600] + "-" * 300 + noise, "abc-" * 40_000]
    monkeypatch.setattr(module, "SLICE", size)
    for text in (t.encode() for t in texts):
        anchor, begin = anchors(text, 100, 24)
        step = np.diff(np.append(begin, max(0, len(text) - 99)))
        assert _trains_as_runs(text) == list(zip(anchor.tolist(), begin.tolist(), step.tolist()))


def test_long_runs_lose_all_but_the_first_string(spark):
    docs = [(1, "-" * 5000 + "end"), (2, "x" + "-" * 3000), (3, "ab" * 2000), (4, "b" + "ab" * 300),
            (5, "-" * 99), (6, "abc" * 500 + "-" * 150 + "abc" * 100)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = drop_repeats(importable(spark) and frame).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == without_strings(docs, 100)


def test_a_run_of_16_mb_within_1_gb():
    """All steps of one document, under a limit of the process's memory."""
    import subprocess

    code = """
import resource
import pyarrow as pa
import tidepoint.llm.bytespans as b
import numpy as np
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = b"-" * (16 << 20)
docs = pa.table([pa.array([1], pa.int64()), pa.array([text], pa.binary())], ["doc_id", "text"])
sent = [r for x in b._send_anchors(100, 24, 1, 1)(iter(docs.to_batches())) for r in x.to_pylist()]
def table(rows, schema):
    names = b._names(schema)
    return pa.Table.from_pylist([{n: r[n] for n in names} for r in rows],
        pa.schema([(n, pa.int64() if i == 0 else pa.binary()) for i, n in enumerate(names)]))
groups = {}
for r in sent:
    groups.setdefault(r["grp"], []).append(r)
known = [r for g in groups.values() for r in b._known_anchors(1, 1 << 40)(table(g, b._SENT)).to_pylist()]
known = table([r for r in known if r["block"] != b._HOT_BLOCK], b._KNOWN)
regions = b._regions(100, 24, 1, 1, np.zeros(0, np.uint64))(docs, known).to_pylist()
groups = {}
for r in regions:
    groups.setdefault(r["grp"], []).append(r)
spans = [r for g in groups.values() for r in b._expand(100, 1)(table(g, b._REGIONS)).to_pylist()]
got = b._answer(False)(docs, table(spans, b._SPANS)).to_pylist()[0]
assert got["n_spans"] == 1
print(got["n_removed"], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ROOT}
    )
    assert done.returncode == 0, done.stderr[-2000:]
    removed, peak = map(int, done.stdout.split())
    # The second string starts at byte 1, so only the first byte stays.
    assert removed == (16 << 20) - 1 and peak < 1024


def test_ties_across_65536_go_to_the_left():
    rng = random.Random(6)
    edge = 1 << 16
    head = "".join(rng.choice("abcdefgh ") for _ in range(edge - 46))
    text = (head + "-" * 110 + "".join(rng.choice("abcdefgh ") for _ in range(300))).encode()
    grams = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), 24)
    dashes = np.flatnonzero((grams == ord("-")).all(axis=1))
    anchor, begin = anchors(text, 100, 24)
    # Where the run of dashes is the least of a window, the window's first whole gram counts.
    plain, _ = anchors(b"-" * 100, 100, 24)
    starts = begin[anchor == plain[0]]
    inside = [int(s) for s in starts if s >= dashes[0]]
    assert inside[:11] == list(range(dashes[0], dashes[0] + 11))
    for cut in (0, 1, 999, edge - 200):  # the same strings, with the edge at another place
        own, at = anchors(text[cut:], 100, 24)
        assert list(zip(anchor[begin > edge - 150], begin[begin > edge - 150])) == [
            (x, y + cut) for x, y in zip(own, at) if y + cut > edge - 150
        ]


def _arrow(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict(
        {"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]}
    )


def test_string_classes():
    rng = random.Random(1)
    data = bytes(rng.choice(b"ab\0") for _ in range(600)) + b"\0"
    order, number = string_classes(np.frombuffer(data, np.uint8), np.array([600]), 10)
    of = dict(zip(order.tolist(), number.tolist()))
    seen = {}
    for i in range(len(data) - 10):
        assert seen.setdefault(data[i : i + 10], of[i]) == of[i]
    assert len(set(seen.values())) == len(seen)


def test_blocks(spark):
    rows = spark.range(-50, 50).withColumnRenamed("id", "doc_id").withColumn("b", block_column(7))
    pairs = [(r.doc_id, r.b) for r in rows.collect()]
    ids = np.array([d for d, _ in pairs])
    assert block_numbers(ids, 7).tolist() == [b for _, b in pairs]
    for values in ([], [5], [-(2**63), 2**63 - 1], list(range(300)), [7] * 9):
        assert unpack(pack(np.array(values, np.int64))).tolist() == values
