"""Structure repair of conversations as shortest paths, by the auction algorithm.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Rows may be
kept, given another role, deleted, and empty turns may be inserted, each at its price. The
edits of one conversation are the paths of a lattice: a node is a number of rows done and a
state of the pattern, an arc is one edit, costs are whole numbers.

Every node has a price that is never above the cost of an arc plus the price at its end. The
auction holds a path from the origin whose arcs are all tight. If the price of its last node
can rise to the least such sum, it rises and the path is contracted by that node; else the
path is extended by the best arc. When the path reaches the end, the price of the origin is the
least cost. All cheapest paths consist of tight arcs alone, so the arcs that are tight and
lead to the end are traced letter by letter, the least letter first.

Long lattices go in blocks of ``BLOCK`` rows from the end; the prices at the end of a block are
those the block behind it has converged to. So the work per row does not grow with the
conversation, and what is held of one is a letter and four prices per row. Faults are found by
Spark functions, and duplicates by a window over the rows of a conversation; rows stream
through a task in order, first without their texts, then with them beside the finished edits.

Defined cases: a null role, text, turn or ``conv_id`` counts as one space where it is read as
text; rows without ``conv_id`` are one conversation; an empty role reads as one space; a role
whose initial is none of s, u, a cannot be kept; rows of one turn are ordered by the SHA-256 of
role and text; a gap above the largest long is that long; an empty table gives no rows. Columns
besides ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]"
BLOCK = 16
REROLE, DELETE, INSERT, OPEN = 3, 4, 3, 3
LETTERS = "DIKR"  # in the order of ASCII

# States: nothing yet, after s, after u, after a. FOLLOW: where a user or assistant turn leads.
FOLLOW = (2, 2, 3, 2)
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
EXPECTED = ("user", "user", "assistant", "user")
ENDS = (0, 3)
AT_END = (0, 2 * INSERT, INSERT, 0)  # the least cost from each state when all rows are done
LONGEST = 2**63 - 1


def edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Arcs ``letter, cost, state`` that use up a row.

    A symbol is the initial of the row's role, in upper case if the text is cut off, ``-`` for a
    row that must go, ``x`` or ``X`` for any other role.
    """
    arcs = [("D", DELETE, state)]
    if symbol != "-":
        more = OPEN if symbol.isupper() else 0
        kept = KEEP.get(symbol.lower(), (None,) * 4)[state]
        if kept is not None:
            arcs.append(("K", more, kept))
        arcs.append(("R", REROLE + more, FOLLOW[state]))
    return arcs


def least(symbol: str) -> int:
    return DELETE if symbol == "-" else OPEN if symbol.isupper() else 0


def arcs_of(symbols: str, row: int, state: int) -> list[tuple[str, int, int, int]]:
    """``letter, cost, row, state`` of all arcs from a node."""
    found = [(c, cost, row + 1, q) for c, cost, q in edits(symbols[row], state)]
    return [*found, ("I", INSERT, row, FOLLOW[state])]


def auction(symbols: str, prices: list[list[int]], origin: tuple[int, int]) -> None:
    """Raise ``prices[row][state]`` until that of the origin is its distance from the end.

    The prices of the last row are fixed: they are its distances.
    """
    end = len(symbols)
    path = [origin]
    while path[-1][0] < end:
        row, state = path[-1]
        best, to = min(
            (cost + prices[i][q], (i, q)) for _, cost, i, q in arcs_of(symbols, row, state)
        )
        if prices[row][state] < best:
            prices[row][state] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


@lru_cache(maxsize=1 << 14)
def block_prices(symbols: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], ...]:
    """Prices of a block's rows, given those right behind it; exact at its first row."""
    low = [min(behind)]
    for symbol in reversed(symbols):
        low.append(low[-1] + least(symbol))
    prices = [[p] * 4 for p in reversed(low[1:])] + [list(behind)]
    for state in (3, 2, 1, 0):
        auction(symbols, prices, (0, state))
    return tuple(tuple(p) for p in prices[:-1])


def lattice_prices(symbols: str, block: int = BLOCK) -> list[tuple[int, ...]]:
    """Prices of all nodes, by row; tight arcs hold all cheapest paths from the origin."""
    prices = [AT_END]
    end = len(symbols)
    while end:
        begin = (end - 1) // block * block
        behind = prices[-1]
        base = min(behind)  # prices above the least, so that like blocks are solved once
        own = block_prices(symbols[begin:end], tuple(p - base for p in behind))
        prices += [tuple(p + base for p in row) for row in reversed(own)]
        end = begin
    prices.reverse()
    return prices


def repair(symbols: str, block: int = BLOCK) -> tuple[int, str]:
    """The least cost and, of the cheapest edits, the letters that are least in ASCII."""
    prices = lattice_prices(symbols, block)
    n = len(symbols)

    def tight(row: int, state: int) -> list[tuple[str, int, int]]:
        arcs = arcs_of(symbols, row, state) if row < n else [("I", INSERT, n, FOLLOW[state])]
        own = prices[row][state]
        return sorted((c, i, q) for c, cost, i, q in arcs if own == cost + prices[i][q])

    leads = [[False] * 4 for _ in range(n)] + [[q in ENDS for q in range(4)]]
    for row in range(n, -1, -1):
        ways = [tight(row, q) for q in range(4)]
        for _ in range(2):  # a turn inserted, or two
            for q in reversed(range(4)):
                leads[row][q] = leads[row][q] or any(leads[i][t] for _, i, t in ways[q])
    letters, row, state = [], 0, 0
    while row < n or state not in ENDS:
        letter, row, state = next(w for w in tight(row, state) if leads[w[1]][w[2]])
        letters.append(letter)
    return prices[0][0], "".join(letters)


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _rows(conversations: DataFrame, **more: Column) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _filled("role").alias("role"),
        _filled("text").alias("text"),
        *[c.alias(n) for n, c in more.items()],
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the faults that a hash of the row deals.

    A dropped row has no copies; it still says that its conversation exists.
    """
    key = F.concat(_filled("conv_id"), F.lit(":"), _filled("turn"))
    rows = _rows(conversations, fault=F.crc32(key.cast("binary")) % 20)
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        copies.alias("copies"),
    )


def _digest() -> Column:
    head = F.concat(F.char_length("role").cast("string"), F.lit(":"))
    return F.substring(F.unhex(F.sha2(F.concat(head, "role", "text"), 256)), 1, 16)


def _signs(rows: DataFrame) -> DataFrame:
    """Rows without texts, in order: ``conv_id, turn, initial, blank, open, again, copies``."""
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id",
        "turn",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
        (~F.col("text").rlike(WORD)).alias("blank"),
        (~last.isin(".", "!", "?")).alias("open"),
        _digest().alias("digest"),
        "copies",
    ).repartition("conv_id")
    # Placed by conversation already, so only sorted again.
    same = F.expr(
        "row_number() over (partition by conv_id, copies > 0, digest order by turn nulls first)"
    )
    return (
        narrow.withColumn("again", same > 1)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest", "again")
        .drop("digest")
    )


_FOUND = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string"
)


class _Signs:
    """What is known of the conversation that streams through."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.symbols: list[str] = []
        self.first = self.turn = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, initial: str, blank: bool, cut: bool, again: bool) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        symbol = initial
        if blank:
            self.blank, symbol = self.blank + 1, "-"
        elif again:
            self.duplicate, symbol = self.duplicate + 1, "-"
        elif cut:
            self.truncated, symbol = self.truncated + 1, initial.upper()
        self.symbols.append(symbol)

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        cost, audit = repair("".join(self.symbols))
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (self.conv_id, min(gaps, LONGEST), *counts, cost, audit)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def out(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found), kinds)], names
        )

    now, found = None, []
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
        for conv_id, turn, initial, blank, cut, copies, again in rows:
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    found.append(now.result())
                now = _Signs(conv_id)
            for copy in range(copies):
                now.row(turn, initial, blank, cut, again or copy > 0)
        if found:
            yield out(found)
            found = []
    if now is not None:
        yield out([now.result()])


_REPAIRED = f"{_FOUND}, repaired_sha256 string"


class _Repaired:
    """The repaired text of one conversation, as a running digest."""

    def __init__(self, found: tuple):
        self.found, self.audit = found, found[7]
        self.at = self.state = 0
        self.digest, self.empty = hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.write(EXPECTED[self.state], "")
            self.state, self.at = FOLLOW[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self.write(role, text)
            self.state = KEEP[role[0]][self.state]
        elif letter == "R":
            self.write(EXPECTED[self.state], text)
            self.state = FOLLOW[self.state]

    def result(self) -> tuple:
        self.inserted()
        return (*self.found, self.digest.hexdigest())


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``found`` of a conversation comes before its rows, which come in order."""
    names = [c.split()[0] for c in _REPAIRED.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def out(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*done), kinds)], names
        )

    now, done = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for found, role, text, copies in zip(*columns):
            if found is not None:
                if now is not None:
                    done.append(now.result())
                now = _Repaired(tuple(found.values()))
            else:
                for _ in range(copies):
                    now.row(role, text)
        if done:
            yield out(done)
            done = []
    if now is not None:
        yield out([now.result()])


def repaired_conversations(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """A row per conversation, see ``_REPAIRED``.

    ``copies``: a column that says how often a row is there, as ``damaged`` gives it; a row that
    is there no time still names its conversation.
    """
    times = F.lit(1) if copies is None else F.coalesce(F.col(copies).cast("int"), F.lit(0))
    rows = _rows(conversations, copies=times)
    found = _signs(rows).mapInArrow(_solve, _FOUND)
    heads = found.select(
        "conv_id",
        F.struct(*found.columns).alias("found"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("int").alias("copies"),
        F.lit(None).cast("binary").alias("digest"),
    )
    turns = rows.where("copies > 0").select(
        "conv_id",
        F.lit(None).cast(heads.schema["found"].dataType).alias("found"),
        "turn",
        "role",
        "text",
        "copies",
        _digest().alias("digest"),
    )
    ordered = (
        heads.unionByName(turns)
        .repartition("conv_id")
        .sortWithinPartitions(
            "conv_id", F.col("found").isNull(), F.col("turn").asc_nulls_first(), "digest"
        )
    )
    return ordered.select("found", "role", "text", "copies").mapInArrow(_rewrite, _REPAIRED)
