"""Secrets: fixed patterns, and strings that a tokenizer finds no words in.

The base patterns give assignments, access keys and hexadecimal runs. The method adds random
strings: a token vocabulary learnt from text spends few characters per token on text and
about two on random letters and digits, whatever their length. Candidates are runs of
``MIN_CHARS`` or more letters, digits and ``+/_=-``; known digests (by length and alphabet) and
identifiers (UUIDs, numbers, dates, and names of several parts in which the tokenizer does find
words) are excluded before a ratio is taken. For letters of one case the ratio is lower: of random
ones of 16 to 40 letters 98.3 to 100 % fall below it, and of the 1,480 such words of 16 or more
letters in 10,000 documents of made-up text 54.

Positions count code points, ends are exclusive. Defined cases: a null or empty text has no
spans; repeated rows are judged each for itself; overlapping spans of different kinds are all
reported; an empty table gives no rows. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidepoint.llm.tokens import default_vocabulary, encoding

KINDS = ("assign", "access", "hex", "random")
MIN_CHARS = 16
MAX_RATIO = 2.4  # characters per token
ONE_CASE_RATIO = 2.2  # of letters of one case

# The base patterns. Letters of the names stand in either ASCII case.
_ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

# Part of every name: most texts have none, and are spared the full pattern.
_NAMES = re.compile(r"(?ai:passw|secret|token|api_?key)")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"(?i:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})")
_PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z])|[0-9]+")
_JOINERS = re.compile(r"[+/_=-]+")
_STAMP = re.compile(r"[0-9]{8}T?[0-9]{4,}Z?|[0-9]+")


def is_digest(text: str) -> bool:
    return len(text) in _DIGEST_CHARS and _DIGEST.fullmatch(text) is not None


def is_identifier(text: str, encode, max_ratio: float) -> bool:
    """UUIDs, numbers, dates, and names: several parts, few for their length, each of one kind
    of character, and the letters of them words to the tokenizer."""
    if _UUID.fullmatch(text):
        return True
    bare = _JOINERS.sub("", text)
    if not bare or _STAMP.fullmatch(bare):
        return True
    parts = _PART.findall(text)
    if len(parts) < 2 or sum(map(len, parts)) != len(bare) or len(bare) < 4 * len(parts):
        return False
    words = [p for p in parts if p.isalpha()]
    return sum(map(len, words)) >= max_ratio * sum(len(encode(w)) for w in words)


def random_spans(text: str, encode, max_ratio: float) -> list[tuple[int, int]]:
    spans = []
    for match in _CANDIDATE.finditer(text):
        word = match[0]
        if is_digest(word) or is_identifier(word, encode, max_ratio):
            continue
        one_case = word.isalpha() and (word.islower() or word.isupper())
        ratio = min(max_ratio, ONE_CASE_RATIO) if one_case else max_ratio
        if len(word) < ratio * len(encode(word)):
            spans.append(match.span())
    return spans


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the base kinds, in the order of ``KINDS``."""
    assign = []
    if _NAMES.search(text):
        assign = [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    access = []
    if "AKIA" in text:
        access = [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    return [assign, access, [m.span() for m in _LONG_HEX.finditer(text)]]


# Runs are maximal, so those of 16 or more are the matches of the base pattern that pass.
_LONG_HEX = re.compile(_HEX.pattern[:-1] + "{16,}")


def joined(kinds: list[list[tuple[int, int]]]) -> str:
    spans = sorted(
        (begin, order, end) for order, found in enumerate(kinds) for begin, end in found
    )
    return ",".join(f"{KINDS[order]}:{begin}:{end}" for begin, order, end in spans)


def secret_spans(
    docs: DataFrame,
    vocabulary: str | None = None,
    pattern: str | None = None,
    max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """A row per document: ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    ``vocabulary``: path of token ranks in the tiktoken format, the same on all executors.
    """
    vocabulary, pattern = default_vocabulary(vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary, pattern).encode_ordinary
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                added = random_spans(text or "", encode, max_ratio)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*map(len, base), len(added), digest, joined([*base, added])))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, "
        "base_sha256 string, spans string",
    )
