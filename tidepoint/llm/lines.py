"""Lines that many documents share, by counted hashes.

Texts are split at line feeds. A line's key is the line without white space (space and 9 to
13) at both ends, with A-Z in lower case. Keys long enough are hashed; distinct documents are
counted per hash, in two steps, first by hash and document, so a line that a third of all
documents hold is spread over all tasks until only counts are left. Keys that reach the
threshold keep their lines in the smallest document that holds them. What moves are hashes,
ids and places; a hash is the first 128 bits of a SHA-256. Marked places go back to their
document, and a text moves once, to be put together again by position.

Defined cases: a null or empty text is one empty line; a line that repeats inside one document
counts once, and stays or goes with all its repeats; rows that share an id are one document
for the counts and are answered each; a null id orders before every other id; an empty table
gives no rows. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.llm.blocks import id_column
from tidepoint.llm.skew import join_groups
from tidepoint.session import pin

MIN_CHARS = 10
MIN_DOCUMENTS = 2
SPACE = " \t\n\v\f\r"

_OUT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, kept_text string"


def line_key(line: Column) -> Column:
    return F.translate(
        F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase
    )


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, id, tag, text``; the tag tells texts apart that share an id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        id_column().alias("id"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
    )


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, tag, place, digest`` of every line whose key has at least ``min_chars``."""
    lines = _texts(docs).select(
        "id", "tag", F.posexplode(F.split("text", "\n", -1)).alias("place", "line")
    )
    keys = lines.select("id", "tag", "place", line_key(F.col("line")).alias("key"))
    digest = F.substring(F.unhex(F.sha2("key", 256)), 1, 16)
    return keys.where(F.char_length("key") >= min_chars).select(
        "id", "tag", "place", digest.alias("digest")
    )


def shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``digest, n_documents, first_id, n_lines`` of the keys over the threshold."""
    return (
        line_hashes(docs, min_chars)
        .groupBy("digest")
        .agg(
            F.count_distinct("id").alias("n_documents"),
            F.min("id").alias("first_id"),
            F.count("*").alias("n_lines"),
        )
        .where(F.col("n_documents") >= min_documents)
    )


def _assemble(with_text: bool):
    """Texts without their marked lines, from ``doc_id, text, places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, places in zip(
                batch.column(0).to_pylist(),
                batch.column(1).cast(pa.binary()).to_pylist(),
                batch.column(2),
            ):
                lines = text.split(b"\n")
                n, rest = len(lines), text
                if places.is_valid:
                    gone = np.zeros(n, bool)
                    gone[places.values.to_numpy()] = True
                    lines = [line for line, g in zip(lines, gone.tolist()) if not g]
                    rest = b"\n".join(lines)
                digest = hashlib.sha256(rest).hexdigest()
                out.append((doc_id, n, n - len(lines), digest, rest if with_text else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            if columns:
                columns[4] = columns[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return run


def drop_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    with_text: bool = True,
) -> DataFrame:
    """A row per document: ``doc_id, n_lines, n_dropped, kept_sha256, kept_text``."""
    shared = pin(shared_lines(docs, min_chars, min_documents))
    found = join_groups(line_hashes(docs, min_chars), shared, "digest", "n_lines", "tag")
    marks = (
        found.where("id > first_id")
        .groupBy("id", "tag")
        .agg(F.collect_set("place").alias("places"))
    )
    rows = _texts(docs).join(marks, ["id", "tag"], "left").select("doc_id", "text", "places")
    return rows.mapInArrow(_assemble(with_text), _OUT)
