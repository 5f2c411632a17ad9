"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit integers make all signature coordinates: the first scatters
the shingles once, the second is read at a place that moves on by one, circularly, for each
coordinate. Bands of ``rows`` coordinates give buckets.

Documents with the same shingle set are one class, found by a 128-bit sum over the set, and
only their smallest id goes on. Every comparison is made on the full sets of shingles.

No bucket is expanded into its pairs. The smallest member of a bucket is its centre and is
compared with the others. As Jaccard distance is a metric, a member within ``NEAR`` of the
centre has all its possible partners within ``FAR`` of it. Pairs with a centre that are
similar enough are links; those within ``FAR`` make families. The members that their centre
does not settle are a family of their own. So every link that a bucket offers is within a
family, whose members outside its largest component are then compared with those members that
share one of their rarest shingles, as every similar pair does, by an inverted index in tasks
of bounded size, which return links only. Large families are dealt by their rare shingles: what
occurs once, or with no document that seeks a link, is sent nowhere.

Defined cases: a null or empty text, or one of blanks, has an empty set and is its own
component; rows that repeat an id are one document, for whose links the text that orders
first is read; a null id is never linked; an empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.llm.components import components
from tidepoint.llm.words import mix, slices, word_fingerprints
from tidepoint.session import pin, scratch_path

BANDS = 40
ROWS = 6
WORDS = 5
THRESHOLD = 80  # per cent
NEAR = 50  # per cent of similarity to a centre that settles a member
FAR = 30  # at least 20 less, as THRESHOLD allows a distance of 20
BLOCK_SHINGLES = 1_000_000  # of the members that one task compares with another block
FREQUENT = 64  # a token that one in so many members of a large family has comes late in order

_U = np.uint64
_V = np.uint32


def _permute(x: np.ndarray, key: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place."""
    x ^= _V(key)
    x ^= x >> _V(16)
    x *= _V(0x85EBCA6B)
    x ^= x >> _V(13)
    x *= _V(0xC2B2AE35)
    x ^= x >> _V(16)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set of 64-bit shingles."""
    scattered = _permute((shingles >> _U(32)).astype(_V), 0x2545F491)
    step = max(1, (1 << 16) // len(scattered))
    result = np.empty(size, _V)
    for k in range(0, size, step):
        shifts = np.arange(k, min(size, k + step), dtype=_V)
        result[k : k + step] = _permute(scattered + shifts[:, None], 0x9E3779B9).min(axis=1)
    return result


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for begin, end in slices(texts):
        words, offsets = word_fingerprints([t.lower() for t in texts[begin:end]])
        for i, j in zip(offsets[:-1], offsets[1:]):
            own = words[i:j]
            if not len(own):
                yield np.zeros(0, _U)
                continue
            width = min(n, len(own))
            grams = own[: len(own) - width + 1].copy()
            for k in range(1, width):
                grams *= _U(0x9E3779B97F4A7C15)
                grams += own[k : len(own) - width + 1 + k]
            yield np.unique(mix(grams + _U(width)))


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sketcher(n: int, bands: int, rows: int):
    size = bands * rows
    salts = mix(np.arange(1, bands + 1, dtype=_U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums, others, buckets = [], [], [], []
            for shingles in shingle_sets(_texts(batch.column(1)), n):
                counts.append(len(shingles))
                sums.append(shingles.sum(dtype=_U).astype(np.int64))
                others.append(mix(shingles).sum(dtype=_U).astype(np.int64))
                if not len(shingles):
                    buckets.append(None)
                    continue
                parts = signature(shingles, size).reshape(bands, rows).astype(_U)
                keys = salts.copy()
                for k in range(rows):
                    keys = mix(keys ^ parts[:, k])
                buckets.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(others, pa.int64()),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "s1", "s2", "buckets"],
            )

    return run


def _sizes_fit(n1: Column, n2: Column, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def scored(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``a, b, common, total``: sizes of intersection and union of the full shingle sets.

    Both joins are on an id that is unique on the other side, so that adaptive execution can
    split an id with very many pairs. Rows come sorted by ``a``; its set is made once.
    """
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for batch in batches:
            first, second = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            common, total = [], []
            others = shingle_sets(_texts(batch.column(3)), words)
            for a, text, other in zip(first, batch.column(2), others):
                if known != a:
                    own = next(shingle_sets([(text.as_py() or "").encode()], words))
                    known = a
                both = np.isin(other, own, assume_unique=True).sum()
                common.append(int(both))
                total.append(len(own) + len(other) - int(both))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(common, pa.int64()),
                    pa.array(total, pa.int64()),
                ],
                ["a", "b", "common", "total"],
            )

    met = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return met.mapInArrow(run, "a bigint, b bigint, common bigint, total bigint")


def centre_scores(
    members: DataFrame, texts: DataFrame, words: int, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Scores of bucket members with their centre, ``a, b, common, total``, and the members
    ``bucket, x, n`` that their centre does not settle.

    ``members``: ``bucket, x, n``.
    """
    centres = members.groupBy("bucket").agg(F.min(F.struct("x", "n")).alias("c"))
    rows = (
        members.join(centres, "bucket")
        .select("bucket", F.col("c.x").alias("a"), F.col("c.n").alias("na"), "x", "n")
        .where("x <> a")
    )
    pairs = rows.where(_sizes_fit(F.col("n"), F.col("na"), FAR))
    pairs = pairs.select("a", F.col("x").alias("b")).distinct()
    scored(pairs, texts, words).write.parquet(f"{folder}/scores")
    scores = members.sparkSession.read.parquet(f"{folder}/scores")
    settled = scores.where(f"100 * common >= {NEAR} * total").select("a", F.col("b").alias("x"))
    left = rows.join(settled, ["a", "x"], "left_anti").select("bucket", "x", "n")
    return scores, left


def left_over(left: DataFrame) -> DataFrame:
    """The unsettled members of buckets with two or more of them as families of their own.

    Many buckets have the same members left; one of them is enough. They are told by a
    128-bit sum over the members.
    """
    sums = left.groupBy("bucket").agg(
        F.count("*").alias("size"),
        F.sum(F.xxhash64("x").cast("decimal(38,0)")).alias("s1"),
        F.sum(F.xxhash64("x", F.lit(1)).cast("decimal(38,0)")).alias("s2"),
    )
    chosen = (
        sums.where("size > 1").groupBy("size", "s1", "s2").agg(F.min("bucket").alias("bucket"))
    )
    return left.join(chosen.select("bucket"), "bucket", "left_semi").select(
        F.col("bucket").alias("k"), "x", "n", F.col("x").alias("c")
    )


def prefix_sizes(n, threshold: int):
    """Tokens that a set of ``n`` is looked up by and is listed under.

    In any one order of all tokens, the first token that two similar sets share is among the
    first ones listed of the smaller set and the first ones looked up of the larger set.
    """
    looked_up = n - -(-threshold * n // 100) + 1
    listed = n - -(-2 * threshold * n // (100 + threshold)) + 1
    return looked_up, listed


def _cross_links(words: int, threshold: int):
    """Links between the strays of a block and members of another component.

    Only members that share one of the rarest tokens of the block with a stray, as
    ``prefix_sizes`` has it, are compared with it, on the full sets.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("x").to_numpy()
        parts = table.column("c").to_numpy()
        stray = table.column("stray").to_numpy(zero_copy_only=False)
        sets = list(shingle_sets(_texts(table.column("text")), words))
        sizes = np.array([len(s) for s in sets])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        values, tokens, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(values))
        owner = np.repeat(np.arange(len(sets)), sizes)
        tokens = rank[tokens]
        tokens = tokens[np.lexsort((tokens, owner))]
        place = np.arange(len(tokens)) - bounds[owner]
        looked_up, listed = prefix_sizes(sizes, threshold)

        at = np.flatnonzero(~stray[owner] & (place < looked_up[owner]))
        at = at[np.argsort(tokens[at], kind="stable")]
        keys, holder, in_list = tokens[at], owner[at], (place < listed[owner])[at]
        marked = np.zeros(len(values), bool)
        a, b = [], []
        for i in np.flatnonzero(stray):
            own = tokens[bounds[i] : bounds[i + 1]]
            first = own[: looked_up[i]]
            low = np.searchsorted(keys, first, "left")
            count = np.searchsorted(keys, first, "right") - low
            hits = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            of_list = np.repeat(np.arange(len(first)) < listed[i], count)
            other = holder[hits]
            n, m = sizes[i], sizes[other]
            fits = (in_list[hits] & (m <= n)) | (of_list & (m >= n))
            fits &= (100 * np.minimum(n, m) >= threshold * np.maximum(n, m))
            other = np.unique(other[fits & (parts[other] != parts[i])])
            if not len(other):
                continue
            marked[own] = True
            m = sizes[other]
            ends = np.cumsum(m)
            spots = np.repeat(bounds[other] - ends + m, m) + np.arange(ends[-1])
            common = np.add.reduceat(marked[tokens[spots]], ends - m, dtype=np.int64)
            marked[own] = False
            other = other[100 * common >= threshold * (n + m - common)]
            _, firsts = np.unique(parts[other], return_index=True)
            a.extend([ids[i]] * len(firsts))
            b.extend(ids[other[firsts]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _frequent(words: int, share: int):
    """``k, token, rows``: the tokens that one in ``share`` members of a chunk has, or more.

    A chunk of fewer members gives none, so there are at most ``BLOCK_SHINGLES`` of them.
    """

    def run(table: pa.Table) -> pa.Table:
        sets = list(shingle_sets(_texts(table.column("text")), words))
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = (counts * share >= len(sets)) & (len(sets) >= share)
        k = table.column("k")[0].as_py()
        return pa.table(
            {
                "k": pa.array([k] * int(often.sum()), pa.int64()),
                "token": pa.array(tokens[often].view(np.int64)),
                "rows": pa.array(counts[often].astype(np.int64)),
            }
        )

    return run


_POSTINGS = "k bigint, token bigint, x bigint, n bigint, c bigint, stray boolean, listed boolean"


def _rarest(words: int, threshold: int):
    """``_POSTINGS``: the members of a chunk of a family by the tokens they are looked up by.

    Tokens are in the order of their hashes, then the frequent ones in the order given.
    """

    def run(table: pa.Table, often: pa.Table) -> pa.Table:
        names = ["k", "x", "n", "c", "stray"]
        if not table.num_rows:
            empty = {c: table.column(c) for c in names}
            return pa.table(
                empty | {"token": pa.array([], pa.int64()), "listed": pa.array([], pa.bool_())}
            ).select(["k", "token", "x", "n", "c", "stray", "listed"])
        last = np.array(
            often.column("tokens")[0].as_py() if often.num_rows else [], np.int64
        ).view(_U)
        by_value = np.argsort(last)
        tokens, lists, lengths = [], [], []
        for own in shingle_sets(_texts(table.column("text")), words):
            rank = np.zeros(len(own), np.int64)
            if len(last):
                at = np.minimum(np.searchsorted(last[by_value], own), len(last) - 1)
                found = last[by_value[at]] == own
                rank[found] = 1 + by_value[at[found]]
            looked_up, listed = prefix_sizes(len(own), threshold)
            tokens.append(own[np.argsort(rank, kind="stable")[:looked_up]])
            lists.append(np.arange(looked_up) < listed)
            lengths.append(looked_up)
        rows = table.select(names).take(np.repeat(np.arange(table.num_rows), lengths))
        columns = {c: rows.column(c) for c in names}
        columns["token"] = pa.array(np.concatenate(tokens).view(np.int64))
        columns["listed"] = pa.array(np.concatenate(lists))
        return pa.table({c: columns[c] for c in ("k", "token", "x", "n", "c", "stray", "listed")})

    return run


def _blocks(size: Column) -> Column:
    return F.ceil(size / BLOCK_SHINGLES).cast("int")


def token_blocks(rows: DataFrame, texts: DataFrame, words: int, threshold: int) -> DataFrame:
    """``k, b, x, n, c, stray``: large families dealt by the rarest tokens of their members.

    ``rows``: ``k, x, n, c, stray, n_members, members``. A member goes only where it shares a
    rare token with others, a stray among them, so its copies do not grow with its family.
    """
    chunk = F.pmod(F.xxhash64("x"), F.col("n_members")).cast("int")
    chunks = rows.withColumn("i", chunk).join(texts.withColumnRenamed("doc_id", "x"), "x")
    often = (
        chunks.select("k", "i", "text")
        .groupBy("k", "i")
        .applyInArrow(_frequent(words, FREQUENT), "k bigint, token bigint, rows bigint")
        .groupBy("k", "token")
        .agg(F.sum("rows").alias("rows"))
        .join(rows.groupBy("k").agg(F.max("members").alias("members")), "k")
        .where(F.col("rows") * FREQUENT >= F.col("members"))
        .groupBy("k")
        .agg(F.array_sort(F.collect_list(F.struct("rows", "token")))["token"].alias("tokens"))
    )
    targets = rows.groupBy("k").agg(F.max("n_members").alias("n_members")).join(often, "k")
    each = F.explode(F.sequence(F.lit(0), F.col("n_members") - 1))
    targets = targets.select("k", "tokens", each).toDF("k", "tokens", "i")
    postings = pin(
        chunks.select("k", "i", "x", "n", "c", "stray", "text")
        .groupBy("k", "i")
        .cogroup(targets.groupBy("k", "i"))
        .applyInArrow(_rarest(words, threshold), _POSTINGS)
    )
    useful = (
        postings.groupBy("k", "token")
        .agg(F.count("*").alias("rows"), F.max("stray").alias("s"), F.max("listed").alias("l"))
        .where("rows > 1 and s and l")
        .select("k", "token")
    )
    met = pin(postings.join(useful, ["k", "token"], "left_semi"))
    counts = met.groupBy("k").agg(_blocks(F.sum("n")).alias("n_blocks"))
    block = F.pmod(F.xxhash64("token"), F.col("n_blocks")).cast("int")
    return met.join(counts, "k").select("k", block.alias("b"), "x", "n", "c", "stray").distinct()


def dealt_families(
    families: DataFrame, texts: DataFrame, words: int, threshold: int
) -> DataFrame:
    """``k, b, i, j, x, c, stray``: members of families, and strays among them, by task.

    ``families``: ``k, x, n, c``. A family that fits into few blocks of bounded size goes by
    blocks of strays and of members, each with each. Where that would copy more shingles than
    dealing by tokens, it goes by tokens; a token that very many share is cut likewise.
    """
    looked_up = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    parts = families.groupBy("k", "c").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum(F.col("n") * looked_up).alias("t")
    )
    stats = (
        parts.groupBy("k")
        .agg(
            F.max_by("c", F.struct("rows", "c")).alias("main"),
            F.max(F.struct("rows", "c", "n"))["n"].alias("main_n"),
            F.sum("n").alias("total_n"),
            F.sum("t").alias("token_copies"),
            F.sum("rows").alias("members"),
            F.count("*").alias("n_parts"),
        )
        .where("n_parts > 1")
        .withColumn("stray_n", F.col("total_n") - F.col("main_n"))
        .withColumn("n_members", _blocks(F.col("total_n")))
        .withColumn("n_strays", _blocks(F.col("stray_n")))
    )
    copies = F.col("n_strays") * F.col("total_n") + F.col("n_members") * F.col("stray_n")
    rows = pin(
        families.join(stats, "k").select(
            "k",
            "x",
            "n",
            "c",
            (F.col("c") != F.col("main")).alias("stray"),
            "n_members",
            "members",
            ((F.col("n_members") > 1) & (copies > F.col("token_copies"))).alias("by_token"),
        )
    )
    large = rows.where("by_token")
    groups = rows.where("not by_token").select("k", F.lit(0).alias("b"), "x", "n", "c", "stray")
    if not large.isEmpty():
        groups = pin(groups.unionByName(token_blocks(large, texts, words, threshold)))
    sizes = (
        groups.groupBy("k", "b")
        .agg(
            _blocks(F.sum("n")).alias("n_members"),
            _blocks(F.sum(F.when(F.col("stray"), F.col("n")))).alias("n_strays"),
        )
        .where("n_strays > 0")
    )
    placed = pin(groups.join(sizes, ["k", "b"]))
    member_block = F.pmod(F.xxhash64("x"), F.col("n_members")).cast("int")
    stray_block = F.pmod(F.xxhash64("x", F.lit(1)), F.col("n_strays")).cast("int")
    as_member = placed.select(
        "k", "b", "x", "c", F.lit(False).alias("stray"), member_block.alias("j"),
        F.explode(F.sequence(F.lit(0), F.col("n_strays") - 1)).alias("i"),
    )
    as_stray = placed.where("stray").select(
        "k", "b", "x", "c", "stray", stray_block.alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("n_members") - 1)).alias("j"),
    )
    return as_member.unionByName(as_stray).select("k", "b", "i", "j", "x", "c", "stray")


def family_links(
    families: DataFrame, texts: DataFrame, words: int, threshold: int
) -> DataFrame:
    """``families``: ``k, x, n, c``. Links from members outside a family's main component."""
    dealt = dealt_families(families, texts, words, threshold)
    dealt = dealt.join(texts.withColumnRenamed("doc_id", "x"), "x")
    return dealt.groupBy("k", "b", "i", "j").applyInArrow(
        _cross_links(words, threshold), "a bigint, b bigint"
    )


def near_classes(
    docs: DataFrame,
    words: int = WORDS,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """A row per document: ``doc_id, n_shingles, component_id, kept``."""
    if not NEAR - (100 - threshold) >= FAR:
        raise ValueError(f"a threshold of {threshold} % needs a wider FAR than {FAR} %")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    folder = scratch_path(spark, "minhash")
    schema = "doc_id bigint, n bigint, s1 bigint, s2 bigint, buckets array<bigint>"
    texts.mapInArrow(_sketcher(words, bands, rows), schema).write.parquet(f"{folder}/sketch")
    sketch = spark.read.parquet(f"{folder}/sketch")
    narrow = sketch.select("doc_id", "n", "s1", "s2")

    classes = (
        narrow.where("n > 0 and doc_id is not null")
        .groupBy("n", "s1", "s2")
        .agg(F.min("doc_id").alias("rep"))
    )
    # A class is represented by the row of its smallest id.
    members = (
        sketch.where("n > 0")
        .select("n", "s1", "s2", F.col("doc_id").alias("rep"), "buckets")
        .join(classes, ["n", "s1", "s2", "rep"], "left_semi")
        .select(F.col("rep").alias("x"), "n", F.explode("buckets").alias("bucket"))
    )
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    members.join(shared, "bucket", "left_semi").distinct().write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")

    ids = members.select(F.col("x").alias("doc_id")).distinct()
    own = texts.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    own.write.option("compression", "zstd").parquet(f"{folder}/texts")
    own = spark.read.parquet(f"{folder}/texts")

    scores, left = centre_scores(members, own, words, folder)
    links = scores.where(f"100 * common >= {threshold} * total").select("a", "b")
    relatives = scores.where(f"100 * common >= {FAR} * total").select("a", "b")
    parts = components(links)
    families = (
        components(relatives)
        .select(F.col("node").alias("x"), F.col("component").alias("k"))
        .join(members.select("x", "n").distinct(), "x")
        .join(parts.select(F.col("node").alias("x"), F.col("component").alias("c")), "x", "left")
        .select("k", "x", "n", F.coalesce("c", "x").alias("c"))
    )
    families = families.unionByName(left_over(left))
    more = pin(family_links(families, own, words, threshold))
    if not more.isEmpty():
        parts = components(links.union(more))

    placed = narrow.join(classes, ["n", "s1", "s2"], "left").join(
        parts.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")), "doc_id")
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all columns, with one document of each component: the smallest id.

    Rows that share an id stay if one of them is kept.
    """
    kept = near_classes(docs, **options).where("kept").select(F.col("doc_id").alias("kept_id"))
    columns = F.struct(*[named(c) for c in docs.columns])
    rows = docs.select(columns.alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    same = F.col("id").eqNullSafe(F.col("kept_id"))
    return rows.join(kept.distinct(), same, "left_semi").select("row.*")
