"""Plain versions of the operators, and rows with the cases that every operator defines."""

import hashlib
import itertools
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977}x{i // 3}" for i in range(12_000))
PROSE = " ".join(f"term{i * i % 101} of{i}" for i in range(60))

# doc_id, text, source and columns whose names operators use themselves.
CASES = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n ", None),
    (4, "one", "b"),
    (5, PROSE, "b"),
    (5, PROSE, "b"),
    (6, PROSE + " tail", "b"),
    (6, "another text under the same id " + PROSE[:200], "c"),
    (7, LONG, "c"),
    (8, PROSE, "a"),
    (None, PROSE + " of nobody", "a"),
    (9, "é" * 150 + " ü\x00ü", "a"),
    (10, "for " * 80, "c"),
]
CLASHING = ("row", "kept", "n", "length", "block", "id", "shard", "weight", "tokens", "full_hash")


def case_frame(spark, rows=CASES):
    schema = "doc_id bigint, text string, source string, " + ", ".join(
        f"{c} int" for c in CLASHING
    )
    return spark.createDataFrame([(*r, *[7] * len(CLASHING)) for r in rows], schema)


def empty_frame(spark):
    return case_frame(spark, [])


def words(text):
    return WORD.findall(text or "")


def jaccard_components(docs, n, threshold=80):
    """doc_id -> (set size, least id reachable); ids are unique and not null."""
    sets = {}
    for doc_id, text in docs:
        own = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
        width = min(n, len(own))
        grams = zip(*(own[i:] for i in range(width))) if width else ()
        sets[doc_id] = set(grams)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= threshold * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_passages(docs, n):
    """Per row: number of words, removed words, digest of the rest."""
    first = {}
    for doc_id, text in docs:
        own = words(text)
        for i in range(len(own) - n + 1):
            key = tuple(own[i : i + n])
            first[key] = min(first.get(key, doc_id), doc_id)
    rows = []
    for doc_id, text in docs:
        own, gone = words(text), set()
        for i in range(len(own) - n + 1):
            if first[tuple(own[i : i + n])] < doc_id:
                gone.update(range(i, i + n))
        rest = " ".join(w for i, w in enumerate(own) if i not in gone)
        digest = hashlib.sha256(rest.encode()).hexdigest()
        rows.append((doc_id, len(own), len(gone), digest))
    return Counter(rows)


def without_strings(docs, n):
    """Per row: bytes, removed bytes, spans, digest of the rest."""
    first = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - n + 1):
            place = first.setdefault(data[i : i + n], (doc_id, i))
            first[data[i : i + n]] = min(place, (doc_id, i))
    rows = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - n + 1):
            if first[data[i : i + n]] < (doc_id, i):
                gone[i : i + n] = [True] * n
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        rows.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return Counter(rows)
