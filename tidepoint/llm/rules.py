"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once. The ledger keeps, per document, the numbers the rules read
and one integer with a bit per failed rule. Policies are versioned bit masks applied to that
integer, so a new policy or an ablation never reads a text again: how many documents a rule
alone rejects is a bitwise test inside one aggregate.

Words are runs of characters other than space and the control characters 9 to 13. Defined
cases: a null or empty text has no words and fails ``few_words``; a text of blanks the same;
repeated rows are judged each for itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct",
    "n_exclaims",
)

# Failure tests over the measures, in the order of their bits.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "2 * n_exclaims > n_words",
    "small_vocabulary": "20 * n_distinct < n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
POLICIES = {
    "base": BITS["few_words"] | BITS["repeated_windows"],
    "v1": (1 << len(RULES)) - 1,
}

_DROPPED = bytes(set(range(256)) - set(b"#*$%&|<>"))
_CONTINUATION = bytes(range(0x80, 0xC0))


def measure(text: bytes) -> tuple[int, ...]:
    """The measures of one text given in UTF-8, in the order of ``MEASURES``."""
    words = text.split()
    n = len(words)
    seen: set[bytes] = set()
    lines = duplicates = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            duplicates += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        reach = -1  # the last word that is already counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 2 - max(reach, i - 1)
                reach = i + 2
    return (
        n,
        len(b"".join(words).translate(None, _CONTINUATION)),
        len(text.translate(None, _DROPPED)),
        lines,
        duplicates,
        repeated,
        len(set(words)),
        text.count(b"!"),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        columns = list(zip(*(measure(text or b"") for text in texts))) or [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
            ["doc_id", *MEASURES],
        )


def failure_bits() -> Column:
    """One bit per failed rule, from the measures."""
    bits = F.lit(0).cast("bigint")
    for name, test in RULES.items():
        failed = F.when(F.expr(test), F.lit(BITS[name])).otherwise(F.lit(0))
        bits = bits.bitwiseOR(failed.cast("bigint"))
    return bits


def rule_ledger(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, the measures and ``failed_bits``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    measured = docs.select("doc_id", "text").mapInArrow(_measured, schema)
    return measured.withColumn("failed_bits", failure_bits())


def apply_policy(ledger: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy]))
    return ledger.withColumn("kept", failed == 0)


def ablations(ledger: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, and that only it rejects.

    One aggregate over the ledger with a counter per rule and bit test, then one row per rule.
    """
    mask = POLICIES[policy]
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask))
    names = [name for name in RULES if BITS[name] & mask]
    totals = ledger.agg(
        *(F.count_if(failed.bitwiseAND(F.lit(BITS[n])) != 0).alias(f"any_{n}") for n in names),
        *(F.count_if(failed == BITS[n]).alias(f"only_{n}") for n in names),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(n).alias("rule"),
                F.col(f"any_{n}").alias("n_failed"),
                F.col(f"only_{n}").alias("n_only"),
            )
            for n in names
        )
    )
    return totals.select(F.inline(rows))


def keep_good(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that the policy keeps, with all their columns, in one pass."""
    columns = [named(c) for c in docs.columns]
    carried = docs.select(F.struct(*columns).alias("row"), F.col("text").alias("text"))
    schema = T.StructType([carried.schema["row"]])
    for name in MEASURES:
        schema = schema.add(name, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for done in _measured([batch]):
                yield done.rename_columns(["row", *MEASURES])

    judged = carried.mapInArrow(run, schema).withColumn("failed_bits", failure_bits())
    return apply_policy(judged, policy).where("kept").select("row.*")
