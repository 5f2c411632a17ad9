"""The registered query of each operator, with the SQL for the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.llm.bytespans import drop_repeats
from tidepoint.llm.exact import exact_copies
from tidepoint.llm.lines import drop_lines
from tidepoint.llm.minhash import near_classes
from tidepoint.llm.mixing import mixture
from tidepoint.llm.packing import packed_pieces
from tidepoint.llm.passages import drop_passages
from tidepoint.llm.registry import LLM_ORACLES, LLM_QUERIES, llm_query, table
from tidepoint.llm.repair import damaged, repaired_conversations
from tidepoint.llm.rules import MEASURES, POLICIES, apply_policy, rule_ledger
from tidepoint.llm.secrets import secret_spans
from tidepoint.llm.toxicity import toxic_scores, train
from tidepoint.llm.trie import prefix_trie
from tidepoint.llm.warc import read_archive, write_archive
from tidepoint.session import scratch_path

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]

WORD = r"[^\x20\x09-\x0D]+"


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text: its bytes, each followed by eight shifts."""
    steps = (
        f"flatten(list_transform(range(1, len({text}) + 1), lambda i: "
        f"[ascii(substr({text}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    step = (
        "CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) "
        "ELSE a >> 1 END"
    )
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, b: {step}), 4294967295)"


@llm_query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as often as the mixture reads them, with their place in it."""
    return mixture(table(spark, sf_dir, "documents"))


@llm_query(
    "op2_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
    l AS (SELECT html, max(page_id) AS latest FROM p WHERE n >= 1000 GROUP BY html)
    SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
           CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < latest THEN latest END AS refers_to
    FROM p LEFT JOIN l ON p.html = l.html
    """,
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as an archive and read back."""
    folder = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@llm_query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their near duplicates, on shingles of two words."""
    return near_classes(table(spark, sf_dir, "documents"), words=2)


@llm_query(
    "op4_passages",
    rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    w AS (
        SELECT r, doc_id, i, list_slice(words, i, i + 12) AS win
        FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)),
    g AS (SELECT r, i FROM w QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)),
    covered AS (SELECT DISTINCT r, i + k AS p FROM g, range(13) AS ks(k)),
    kept AS (
        SELECT r, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n
        FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d)
        ANTI JOIN covered USING (r, p) GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words,
           (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(rest, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 13-word passages of documents before them."""
    cleaned = drop_passages(table(spark, sf_dir, "documents"), with_text=False)
    return cleaned.drop("kept_text")


@llm_query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed_pieces(table(spark, sf_dir, "documents"))


@llm_query("op6_bytespans")
def op6_bytespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier."""
    return drop_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@llm_query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all documents."""
    return secret_spans(table(spark, sf_dir, "documents"))


@llm_query(
    "op8_rules",
    rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    w AS (
        SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
    again AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
    repeats AS (
        SELECT r, count(DISTINCT i + k) AS n
        FROM again, (VALUES (0), (1), (2)) AS offsets(k) GROUP BY r),
    lines AS (
        SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '{WORD}') GROUP BY r),
    m AS (
        SELECT doc_id, len(words)::BIGINT AS n_words,
               length(array_to_string(words, ''))::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
               coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
               coalesce(lines.n, 0)::BIGINT AS n_lines,
               len(list_distinct(words))::BIGINT AS n_distinct,
               (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclaims
        FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
    b AS (
        SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END
            + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
            + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
            + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
            + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
            + CASE WHEN 2 * n_exclaims > n_words THEN 64 ELSE 0 END
            + CASE WHEN 20 * n_distinct < n_words THEN 128 ELSE 0 END AS bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
           n_distinct, n_exclaims, bits::BIGINT AS failed_bits, (bits & 3) <> 0 AS base_failed,
           bits = 0 AS kept FROM b
    """,
)
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents under the current policy."""
    ledger = apply_policy(rule_ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed_bits").bitwiseAND(F.lit(POLICIES["base"])) != 0
    return ledger.select("doc_id", *MEASURES, "failed_bits", base.alias("base_failed"), "kept")


@llm_query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learnt outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return toxic_scores(docs, train(docs, table(spark, sf_dir, "labels")))


@llm_query(
    "op10_exact",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their group of equal texts."""
    return exact_copies(table(spark, sf_dir, "documents"))


@llm_query(
    "op11_lines",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (
        SELECT r, doc_id, line, place,
               translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT r, doc_id, unnest(lines) AS line,
                     unnest(range(1, len(lines) + 1)) AS place FROM d)),
    k AS (
        SELECT key, min(doc_id) AS first_id FROM l WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    kept AS (
        SELECT r, string_agg(line, chr(10) ORDER BY place) AS rest, count(*) AS n
        FROM l LEFT JOIN k USING (key) WHERE first_id IS NULL OR first_id = doc_id GROUP BY r)
    SELECT doc_id, len(lines)::BIGINT AS n_lines,
           (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
           sha256(coalesce(rest, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that a document before them holds."""
    return drop_lines(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


@llm_query(
    "op12_trie",
    f"""
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
        SELECT conv_id, conv_id - conv_id % 100 AS first_id,
               {_crc32("conv_id::VARCHAR")} % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
    rebuilt AS (
        SELECT c.conv_id, 0 AS part, n, role, text
        FROM c JOIN t ON t.conv_id = c.first_id WHERE n <= h
        UNION ALL
        SELECT c.conv_id, 1, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE n > h),
    p AS (
        SELECT conv_id, row_number() OVER w AS depth, length(text) AS size,
               string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '') OVER w AS path
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, n)
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    n AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size
        FROM p GROUP BY path, depth),
    ends AS (
        SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id)
        USING (conv_id, depth) GROUP BY path),
    childless AS (
        SELECT path FROM n ANTI JOIN (
            SELECT left(path, greatest(length(path) - 64, 0)) AS path FROM n WHERE depth > 0)
        USING (path)),
    below AS (
        SELECT a.path, sum((b.n_convs - 1) * b.size) AS saved,
               count(*) FILTER (b.depth = a.depth + 1) AS children, count(l.path) AS leaves
        FROM n a JOIN n b ON b.depth >= a.depth AND starts_with(b.path, a.path)
        LEFT JOIN childless l ON l.path = b.path GROUP BY a.path)
    SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id,
           n.n_convs::BIGINT AS n_convs, children::BIGINT AS n_children,
           leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM n JOIN below USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN n up ON n.depth > 0 AND up.path = left(n.path, length(n.path) - 64)
    """,
)
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


@llm_query(
    "op13_repair",
    rf"""
    WITH RECURSIVE o AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
        FROM conversations),
    f AS (SELECT *, {_crc32("key")} % 20 AS fault FROM o),
    d AS (
        SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '')
                    ELSE text END AS text,
               unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
    r AS (
        SELECT *, row_number() OVER w AS i, left(role, 1) AS initial,
               NOT regexp_matches(text, '{WORD}') AS blank,
               row_number() OVER (PARTITION BY conv_id, role, text
                                  ORDER BY turn NULLS FIRST, copy) > 1 AS again,
               NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut,
               lag(left(role, 1)) OVER w || left(role, 1) AS pair
        FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy)),
    s AS (
        SELECT *, CASE WHEN blank OR again THEN '-' ELSE initial END AS symbol,
               CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS more FROM r),
    inserts(q, p, letters, price, lines) AS (VALUES
        (0, 0, '', 0, []), (0, 2, 'I', 3, ['user:']), (0, 3, 'II', 6, ['user:', 'assistant:']),
        (1, 1, '', 0, []), (1, 2, 'I', 3, ['user:']), (1, 3, 'II', 6, ['user:', 'assistant:']),
        (2, 2, '', 0, []), (2, 3, 'I', 3, ['assistant:']),
        (3, 3, '', 0, []), (3, 2, 'I', 3, ['user:'])),
    uses(symbol, p, q) AS (VALUES
        ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('a', 2, 3), ('u', 3, 2)),
    arcs AS (
        SELECT symbol, p, q, 'K' AS letter, 0 AS price FROM uses UNION ALL
        SELECT symbol, p, CASE p WHEN 2 THEN 3 ELSE 2 END, 'R', 3
        FROM (SELECT DISTINCT symbol FROM s WHERE symbol <> '-'), range(4) AS states(p) UNION ALL
        SELECT symbol, p, p, 'D', 4 FROM (SELECT DISTINCT symbol FROM s), range(4) AS states(p)),
    best AS (
        SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines
        FROM (SELECT DISTINCT conv_id FROM o)
        UNION ALL
        SELECT conv_id, i, state, cost, audit, lines FROM (
            SELECT b.conv_id, s.i, a.q AS state,
                   b.cost + n.price + a.price
                   + CASE WHEN a.letter = 'D' THEN 0 ELSE s.more END AS cost,
                   b.audit || n.letters || a.letter AS audit,
                   b.lines || n.lines || CASE a.letter WHEN 'D' THEN []
                       WHEN 'K' THEN [s.role || ':' || s.text]
                       ELSE [CASE a.p WHEN 2 THEN 'assistant:' ELSE 'user:' END || s.text] END
                   AS lines
            FROM best b JOIN s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1
            JOIN inserts n ON n.q = b.state JOIN arcs a ON a.p = n.p AND a.symbol = s.symbol)
        QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
    done AS (
        SELECT b.conv_id, b.cost + n.price AS cost, b.audit || n.letters AS audit,
               b.lines || n.lines AS lines
        FROM best b JOIN inserts n ON n.q = b.state
        WHERE n.p IN (0, 3) AND b.i = coalesce(
            (SELECT max(s.i) FROM s WHERE s.conv_id IS NOT DISTINCT FROM b.conv_id), 0)
        QUALIFY row_number() OVER (
            PARTITION BY b.conv_id ORDER BY b.cost + n.price, b.audit || n.letters) = 1),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
               count(*) FILTER (more > 0) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM s GROUP BY conv_id)
    SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
           cost::BIGINT AS cost, audit,
           sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM done LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM done.conv_id
    """,
)
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a hash of their rows and repaired."""
    return repaired_conversations(
        damaged(table(spark, sf_dir, "conversations")), copies="copies"
    )
