"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

All steps are DataFrame functions. Documents are first counted by their length in bytes. Of
those whose length occurs again, the first characters are hashed and counted by length and
prefix hash. Only documents whose pair occurs again have their whole content hashed. To find
the groups no text is shuffled: what moves are lengths, hashes and ids, and every group is
aggregated before it moves, first by document. The largest groups, a bounded number, are
broadcast to their rows, see ``skew``. ``drop_copies`` moves only rows that may have copies.

Defined cases: a null text counts as the empty text; empty texts are equal to each other;
rows that repeat both id and text are one document that counts once per row, and are all
marked as kept if their id is; a null id orders before every other id; an empty table gives
no rows. Columns besides ``doc_id`` and ``text`` are ignored, or carried by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.llm.skew import join_groups
from tidepoint.session import pin

PREFIX_CHARS = 256
BROADCAST_GROUPS = 500_000  # 16 bytes each: the measured bound under which keys are broadcast


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _full_hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _again(rows: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, bool]:
    """The keys that occur again, fixed, and whether they are few; few are broadcast."""
    found = pin(rows.groupBy(*keys).count().where("count > 1").select(*keys))
    few = found.count() <= most
    return (F.broadcast(found) if few else found), few


def _survivors(
    rows: DataFrame, prefix_chars: int, broadcast_groups: int
) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """``rows`` (with ``text``) with ``length``, the lengths that occur again, and the pairs."""
    sized = rows.withColumn("length", F.octet_length("text"))
    lengths, _ = _again(sized.select("length"), ["length"], broadcast_groups)
    headed = sized.join(lengths, "length", "left_semi").select(
        "length", F.xxhash64(F.substring("text", 1, prefix_chars)).alias("prefix")
    )
    return sized, lengths, *_again(headed, ["length", "prefix"], broadcast_groups)


def _with_survival(
    sized: DataFrame, lengths: DataFrame, pairs: DataFrame, prefix_chars: int
) -> DataFrame:
    """Adds ``survives``: length and prefix occur again. A prefix is hashed only then."""
    longer = sized.join(lengths.withColumn("_l", F.lit(True)), "length", "left")
    head = F.when(F.col("_l"), F.xxhash64(F.substring("text", 1, prefix_chars)))
    return (
        longer.withColumn("prefix", head)
        .join(pairs.withColumn("_p", F.lit(True)), ["length", "prefix"], "left")
        .withColumn("survives", F.coalesce("_p", F.lit(False)))
        .drop("_l", "_p", "prefix")
    )


def _groups(hashed: DataFrame) -> DataFrame:
    """Groups of ``doc_id, full_hash``: ``full_hash, keep_id, group_size, n_kept``."""
    per_id = hashed.groupBy("full_hash", "doc_id").agg(F.count("*").alias("n"))
    return (
        per_id.groupBy("full_hash")
        .agg(F.max(F.struct("doc_id", "n")).alias("top"), F.sum("n").alias("group_size"))
        .where("group_size > 1")
        .select(
            "full_hash",
            F.col("top.doc_id").alias("keep_id"),
            "group_size",
            F.col("top.n").alias("n_kept"),
        )
    )


def copy_groups(
    docs: DataFrame,
    prefix_chars: int = PREFIX_CHARS,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Groups of at least two equal texts: ``full_hash, keep_id, group_size, n_kept``, the last
    the number of rows that have the id that stays."""
    rows = docs.select("doc_id", _text().alias("text"))
    sized, lengths, pairs, few = _survivors(rows, prefix_chars, broadcast_groups)
    keyed = sized.join(lengths, "length", "left_semi").withColumn(
        "prefix", F.xxhash64(F.substring("text", 1, prefix_chars))
    )
    full = _full_hash(F.col("text")).alias("full_hash")
    if few:
        hashed = keyed.join(pairs, ["length", "prefix"], "left_semi").select("doc_id", full)
    else:
        # Beyond the bound the pairs are shuffled, and so is the hash instead of the text.
        hashed = keyed.select("doc_id", "length", "prefix", full).join(
            pairs, ["length", "prefix"], "left_semi"
        )
    return _groups(hashed.select("doc_id", "full_hash"))


def exact_copies(docs: DataFrame, **options) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups = pin(copy_groups(docs, **options))
    rows = docs.select("doc_id", _full_hash(_text()).alias("full_hash"))
    joined = join_groups(
        rows, groups, "full_hash", "group_size", "doc_id", inner=False
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("full_hash")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame,
    prefix_chars: int = PREFIX_CHARS,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """``docs`` with all columns, without the copies; of repeated rows one remains.

    Rows whose length or prefix is single go straight through: their content is not hashed
    and they do not move.
    """
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("doc_id"),
        _text().alias("text"),
    )
    sized, lengths, pairs, _ = _survivors(rows, prefix_chars, broadcast_groups)
    marked = _with_survival(sized, lengths, pairs, prefix_chars)
    single = marked.where(~F.col("survives")).select("row")
    several = marked.where("survives").select(
        "row", "doc_id", _full_hash(F.col("text")).alias("full_hash")
    )
    groups = pin(_groups(several.select("doc_id", "full_hash")))
    joined = join_groups(
        several, groups, "full_hash", "group_size", "doc_id", inner=False
    )
    kept = joined.where(
        F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
    if not groups.where("n_kept > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "full_hash"])
    return single.unionByName(kept.select("row")).select("row.*")
