"""Mixing sources by temperature, realised as budgeted permutations of blocks.

A source's weight is its share of the tokens to the power of an exponent between 0 (all
sources alike) and 1 (as they come), normalised. The exponent is the one nearest to the
target entropy at which no source is read more often than the repetition limit. It is found by
bisection, many points at a time, each pass one aggregate over the table of sources, so that
the number of sources is not bounded by the driver.

The budget is the least that reads every source at least once; another may be given. A source
is read in epochs. An epoch is a permutation of its blocks (documents dealt by a hash into
blocks of about ``BLOCK_TOKENS``), a new one each time, and of the documents in each block. The
last, partial epoch is cut where the budget is used up; the document at the cut still belongs
to it. Sums down to the cut go by ranges of the permutation, then blocks, then documents, so
no task orders a whole source. ``slot`` orders the blocks: sorted by it, all sources run
through side by side in proportion to their weights; ``place`` orders the documents of a block.

Tokens are runs of characters other than space and 9 to 13. Defined cases: null or empty texts
have no tokens, use no budget and are part of every full epoch; a source of only such texts is
read once; a null source is a source; rows that repeat an id go together; an empty table gives
no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepoint.functions.columns import named
from tidepoint.session import pin

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_TOKENS = 100_000
RANGES = 4096
MAX_REPEATS = 4.0
ENTROPY = 0.95  # of the entropy of equal weights
GRID = 32
SMALL_SOURCES = 50_000  # rows under which the plan, one row per source, is broadcast


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _unit(*columns: Column) -> Column:
    """A hash as a number from 0 to 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 12) / F.lit(float(1 << 52))


def _measures(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy (share of the greatest possible) and most repeats at each exponent."""
    share = F.col("share")
    columns = []
    for i, a in enumerate(exponents):
        power = F.pow(share, F.lit(a))
        columns += [F.sum(power).alias(f"z{i}"), F.sum(power * F.ln(share) * a).alias(f"h{i}")]
    row = totals.agg(
        F.count("*").alias("n"), F.max("share").alias("top"), F.min("share").alias("low"), *columns
    ).first()
    most = math.log(row.n) or 1.0
    return [
        (
            (math.log(row[f"z{i}"]) - row[f"h{i}"] / row[f"z{i}"]) / most,
            (row.top / row.low) ** (1 - a),
        )
        for i, a in enumerate(exponents)
    ]


def find_exponent(totals: DataFrame, entropy: float, max_repeats: float) -> float:
    """The largest exponent that reaches the entropy, or the least within the repeats.

    ``totals``: ``share`` per source, positive. Both measures are monotonic in the exponent.
    """

    def too_low(measure: tuple[float, float]) -> bool:
        return measure[0] > entropy or measure[1] > max_repeats

    low, high = 0.0, 1.0
    if not too_low(_measures(totals, [low])[0]):
        return low
    while high - low > 1e-9:
        points = [low + (high - low) * i / GRID for i in range(1, GRID)]
        flags = [too_low(m) for m in _measures(totals, points)]
        at = flags.index(False) if False in flags else len(flags)
        low, high = ([low, *points][at]), ([*points, high][at])
    return high


def source_plan(
    narrow: DataFrame,
    entropy: float = ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """A row per source: ``source, tokens, weight, epochs, full, blocks`` and its cut.

    ``narrow``: ``doc_id, source, tokens``.
    """
    totals = pin(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    filled = totals.where("tokens > 0")
    row = filled.agg(F.sum("tokens").alias("all")).first()
    if row["all"] is None:
        weighed = totals.withColumn("weight", F.lit(0.0)).withColumn("epochs", F.lit(1.0))
    else:
        shares = pin(filled.withColumn("share", F.col("tokens") / F.lit(row["all"])))
        exponent = find_exponent(shares, entropy, max_repeats)
        power = F.pow(F.col("tokens") / F.lit(row["all"]), F.lit(exponent))
        sums = shares.agg(
            F.sum(F.pow("share", F.lit(exponent))).alias("z"), F.max("share").alias("top")
        ).first()
        # The largest source has the fewest epochs: its weight is farthest below its share.
        least = row["all"] * sums.top ** (1 - exponent) * sums.z
        total = least if budget is None else float(budget)
        weight = F.when(F.col("tokens") > 0, power / F.lit(sums.z)).otherwise(0.0)
        epochs = F.when(
            F.col("tokens") > 0, F.round(F.lit(total) * F.col("weight") / F.col("tokens"), 9)
        ).otherwise(1.0)
        weighed = totals.withColumn("weight", weight).withColumn("epochs", epochs)
    plan = pin(
        weighed.withColumn("full", F.floor("epochs").cast("int")).withColumn(
            "blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("bigint")
        )
    )
    return pin(_with_cuts(narrow, plan, seed))


def _order(rows: DataFrame, epoch: Column, seed: int) -> DataFrame:
    """Adds ``block`` and the places ``u`` of the block and ``v`` of the document."""
    rows = rows.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks")).cast("bigint")
    )
    return rows.withColumn("u", _unit(F.lit(seed), epoch, F.col("source"), F.col("block"))).withColumn(
        "v", _unit(F.lit(seed), epoch, F.col("doc_id"))
    )


def _with_cuts(narrow: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Adds ``cut_u, cut_block, cut_v, cut_doc``: the last place of the partial epoch."""
    partial = plan.where("tokens > 0 and epochs > full").select(
        F.col("source").alias("s"),
        "blocks",
        "full",
        ((F.col("epochs") - F.col("full")) * F.col("tokens")).alias("rest"),
    )
    joined = narrow.join(F.broadcast(partial) if _small(partial) else partial,
                         F.col("source").eqNullSafe(F.col("s")))
    rows = _order(joined, F.col("full"), seed).withColumn(
        "range", F.floor(F.col("u") * RANGES).cast("int")
    )
    kept = ["s", "source", "doc_id", "tokens", "rest", "block", "u", "v", "range"]
    rows = rows.select(*kept)

    def boundary(units: DataFrame, *order: str) -> DataFrame:
        until = Window.partitionBy("source").orderBy(*order)
        until = until.rowsBetween(Window.unboundedPreceding, 0)
        summed = units.withColumn("end", F.sum("tokens").over(until))
        start = F.col("end") - F.col("tokens")
        return summed.where((start < F.col("rest")) & (F.col("end") >= F.col("rest"))).select(
            F.col("source").alias("at"), *order, (F.col("rest") - start).alias("left")
        )

    def narrowed(rows: DataFrame, at: DataFrame, *order: str) -> DataFrame:
        same = F.col("source").eqNullSafe(F.col("at"))
        for name in order:
            at = at.withColumnRenamed(name, f"at_{name}")
            same &= F.col(name) == F.col(f"at_{name}")
        return rows.join(at, same).withColumn("rest", F.col("left")).select(*kept)

    ranges = rows.groupBy("source", "range").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")
    )
    rows = pin(narrowed(rows, boundary(ranges, "range"), "range"))
    blocks = rows.groupBy("source", "u", "block").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")
    )
    rows = narrowed(rows, boundary(blocks, "u", "block"), "u", "block")
    ends = boundary(rows, "u", "block", "v", "doc_id").select(
        "at",
        F.col("u").alias("cut_u"),
        F.col("block").alias("cut_block"),
        F.col("v").alias("cut_v"),
        F.col("doc_id").alias("cut_doc"),
    )
    return plan.join(ends, F.col("source").eqNullSafe(F.col("at")), "left").drop("at")


def _small(frame: DataFrame) -> bool:
    return frame.count() <= SMALL_SOURCES


def _emitted(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Each row once per epoch it belongs to. ``rows`` has ``doc_id, source``."""
    chosen = plan.withColumnRenamed("source", "s").drop("tokens")
    chosen = F.broadcast(chosen) if _small(chosen) else chosen
    joined = rows.join(chosen, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    last = _order(joined, F.col("full"), seed)
    place = F.struct("u", "block", "v", F.col("doc_id").alias("d"))
    cut = F.struct(
        F.col("cut_u").alias("u"),
        F.col("cut_block").alias("block"),
        F.col("cut_v").alias("v"),
        F.col("cut_doc").alias("d"),
    )
    more = F.col("cut_u").isNotNull() & (place <= cut)
    epochs = F.col("full") + more.cast("int")
    read = (
        last.where(epochs > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
        .drop("u", "v", "cut_u", "cut_block", "cut_v", "cut_doc")
    )
    ordered = _order(read, F.col("epoch"), seed)
    slot = (F.col("epoch") + F.col("u")) / F.greatest("epochs", F.lit(1e-9))
    return ordered.withColumn("slot", slot)


def mixture(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """A row per reading of a document:
    ``doc_id, source, n_tokens, weight, epochs, epoch, block, slot, place``.

    The mixture is read in the order of ``slot, source, block, place, doc_id``: ``slot`` places
    the block among all others, ``place`` the document in its block.
    """
    narrow = pin(docs.select("doc_id", "source", token_count().alias("tokens")))
    plan = source_plan(narrow, seed=seed, **options)
    return _emitted(narrow, plan, seed).select(
        "doc_id",
        "source",
        F.col("tokens").alias("n_tokens"),
        "weight",
        "epochs",
        "epoch",
        "block",
        "slot",
        F.col("v").alias("place"),
    )


def mixed_documents(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """``docs`` with all columns, each row as often as the mixture reads it."""
    narrow = pin(docs.select("doc_id", "source", token_count().alias("tokens")))
    plan = source_plan(narrow, seed=seed, **options)
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
    )
    return _emitted(rows, plan, seed).select("row.*")
