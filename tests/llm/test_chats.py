"""Shared lines, the trie of conversations and their repair, against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from brute import CASES, case_frame, empty_frame

from tidepoint.llm import repair as rp
from tidepoint.llm.lines import drop_lines, shared_lines
from tidepoint.llm.registry import importable
from tidepoint.llm.repair import damaged, lattice_prices, repair, repaired_conversations
from tidepoint.llm.skew import join_groups
from tidepoint.llm.trie import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, found string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chat_frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


# Joins with heavy groups


def test_join_groups_is_a_join(spark):
    rng = random.Random(1)
    keys = [b"hot"] * 400 + [bytes([rng.randrange(60)]) for _ in range(300)] + [None] * 3
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k binary, i bigint")
    sizes = Counter(k for k in keys if k is not None)
    groups = [(k, n, k.hex()) for k, n in sizes.items() if k != bytes([5])]
    frame = spark.createDataFrame(groups, "k binary, n bigint, name string")
    got = join_groups(rows, frame, "k", "n", "i", heavy=10)
    assert Counter((bytes(r.k), r.i, r.n, r.name) for r in got.collect()) == Counter(
        (k, i, sizes[k], k.hex()) for i, k in enumerate(keys) if k and k != bytes([5])
    )


# Lines


def plain_lines(docs, min_chars, min_documents):
    holders = defaultdict(set)
    low = -(2**63)

    def key(line):
        bare = line.strip(" \t\n\v\f\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), bare)

    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low if doc_id is None else doc_id)
    out = Counter()
    for doc_id, text in docs:
        own = low if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(holders.get(key(x), ())) < min_documents or min(holders[key(x)]) == own
        ]
        out[doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)] += 1
    return out


def line_rows():
    rng = random.Random(4)
    pool = ["", "short", " A Common Line here ", "a common line HERE", "\tÉté long enough\r"]
    pool += [f"line number {i} of all" for i in range(12)] + ["été long enough"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9))), "s") for i in range(60)]
    rows += [(70, "\n\n", "s"), (71, "one long line\n" * 3000, "s"), (72, "One long line", "s")]
    rows += [(5, rows[6][1], "s"), rows[9], rows[9]]  # an id of two texts, a row three times
    return rows + CASES


@pytest.mark.parametrize("min_documents", [2, 4])
def test_lines_as_plain(spark, min_documents):
    rows = line_rows()
    got = drop_lines(case_frame(importable(spark), rows), min_documents=min_documents)
    assert Counter(map(tuple, got.collect())) == plain_lines(
        [r[:2] for r in rows], 10, min_documents
    )


def test_lines_of_nothing(spark):
    assert drop_lines(empty_frame(importable(spark))).collect() == []


def test_line_counts_combine_before_the_hash_is_gathered(spark):
    frame = spark.createDataFrame(
        [(i, "the common line\nanother one %d" % i) for i in range(50)], "doc_id bigint, text string"
    )
    got = shared_lines(frame).collect()
    assert [(r.n_documents, r.first_id, r.n_lines) for r in got] == [(50, 0, 50)]


# Trie


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            body = (role or "", text or "")
            digest = hashlib.sha256(f"{len(body[0])}:{body[0]}{body[1]}".encode()).digest()[:16]
            convs[conv].append(((turn is not None, turn or 0), digest, body))
    own = {c: [b for *_, b in sorted(t, key=lambda x: x[:2])] for c, t in convs.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(first, [])[:h] + own[c][h:]
    return out


def plain_trie(rows):
    chains = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in chains.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    out = Counter()
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in own if len(chains[c]) == len(path))
        out[
            min(own),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(own),
            children[path],
            sum(children[p] == 0 for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            sha(",".join(map(str, ends))),
        ] += 1
    return out


def chat_rows(seed=3, convs=140):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), *range(-130, -95, 5), 301, 302, 405]:
        n = rng.choice([1, 2, 3, 7, 8])
        same = rng.random() < 0.4
        for t in range(n):
            text = f"common {t}" if same and t < 5 else rng.choice(["a.", "b!", "ééé", "", None])
            rows.append((c, t, rng.choice(["user", "assistant", None]), text))
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1200) for t in range(7)]
    rows += [(7, None, "user", "no turn"), (None, 1, "user", "of nobody"), (8, 2, "user", "tie")]
    rows += [(500, t, "user", "x" * (t % 7)) for t in range(900)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_cells", [1 << 16, 1 << 26])
def test_trie_as_plain(spark, max_cells):
    rows = chat_rows()
    short = [r for r in rows if r[0] != 500] if max_cells > 1 << 16 else rows
    got = prefix_trie(chat_frame(spark, short).repartition(5), max_cells=max_cells)
    assert Counter(map(tuple, got.collect())) == plain_trie(short)


def test_trie_with_a_sketch_that_proves_little(spark, monkeypatch):
    from tidepoint.llm import trie

    rows = chat_rows(5, 40)
    want = plain_trie(rows)
    monkeypatch.setattr(trie, "sketch_width", lambda *_: 1 << 16)
    monkeypatch.setattr(
        trie, "count_min", lambda chained, width: trie.np.full(3 * width // 8, 255, trie.np.uint8)
    )
    assert Counter(map(tuple, trie.prefix_trie(chat_frame(spark, rows)).collect())) == want


def test_estimate_one_is_never_wrong(spark):
    from tidepoint.llm import trie

    rows = chat_rows(6)
    chained = trie.chains(chat_frame(spark, rows)).cache()
    width = 256 * 256
    bits = trie.count_min(chained, width)
    digests = trie._digests(trie.pa.array([bytes(r.digests) for r in chained.collect()]))
    seen = Counter(map(bytes, digests))
    again = trie._met_again(digests, bits, width)
    assert all(met for met, d in zip(again, digests) if seen[bytes(d)] > 1)
    assert sum(map(bool, again)) < len(digests)


def test_trie_of_nothing(spark):
    assert prefix_trie(chat_frame(spark, [])).collect() == []


# Repair


def plain_repair(symbols):
    """Least (cost, letters) by steps through the lattice."""
    best = {0: (0, "")}

    def with_inserts(now):
        for _ in range(2):
            for q, (cost, letters) in list(now.items()):
                new = (cost + 3, letters + "I")
                t = rp.FOLLOW[q]
                now[t] = min(now.get(t, new), new)
        return now

    for symbol in symbols:
        best, before = {}, with_inserts(best)
        for q, (cost, letters) in before.items():
            for letter, price, t in rp.edits(symbol, q):
                new = (cost + price, letters + letter)
                best[t] = min(best.get(t, new), new)
    best = with_inserts(best)
    return min(best[q] for q in rp.ENDS if q in best)


def test_repair_finds_the_least_letters():
    for n in range(5):
        for symbols in itertools.product("suaxUA-", repeat=n):
            assert repair("".join(symbols)) == plain_repair(symbols)
    rng = random.Random(2)
    for _ in range(150):
        symbols = "".join(rng.choices("suaSUAxX-", [1, 6, 6, 1, 2, 2, 1, 1, 2], k=rng.randrange(90)))
        assert repair(symbols, block=rng.choice([1, 2, 5, 16, 200])) == plain_repair(symbols)


def test_repair_by_hand():
    assert repair("") == (0, "")
    assert repair("sua") == (0, "KKK")
    assert repair("s") == (4, "D")
    assert repair("u") == (3, "KI")
    assert repair("uu") == (3, "KR")
    assert repair("U-a") == (7, "KDK")


def test_prices_are_feasible_and_exact_at_the_origin():
    rng = random.Random(7)
    symbols = "".join(rng.choices("suaUx-", k=75))
    prices = lattice_prices(symbols)
    for row in range(len(symbols)):
        for state in range(4):
            for _, cost, i, q in rp.arcs_of(symbols, row, state):
                assert prices[row][state] <= cost + prices[i][q]
    assert prices[0][0] == plain_repair(symbols)[0]


def test_long_lattice_takes_work_per_row():
    cost, audit = repair("u" * 200_000)
    assert (cost, len(audit)) == (300_000, 200_000)


def plain_conversations(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
        convs[conv] += [((turn is not None, turn or 0), digest, role, text)] * (
            {0: 0, 3: 2}.get(fault, 1)
        )
    out = Counter()
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[:2])
        seen, symbols, counts, illegal = set(), [], Counter(), 0
        for _, _, role, text in turns:
            bare = text.rstrip(" \t\n\v\f\r")
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not bare:
                counts["blank"] += 1
                symbol = "-"
            elif (role, text) in seen:
                counts["again"] += 1
                symbol = "-"
            elif bare[-1] not in ".!?":
                counts["open"] += 1
                symbol = symbol.upper()
            seen.add((role, text))
            symbols.append(symbol)
        for a, b in itertools.pairwise(turns):
            illegal += a[2][:1] + b[2][:1] not in ("su", "ua", "au")
        cost, audit = plain_repair(symbols)
        lines, left, state = [], iter(turns), 0
        for letter in audit:
            new = ["user", "user", "assistant", "user"][state]
            if letter == "I":
                lines.append(f"{new}:")
                state = rp.FOLLOW[state]
                continue
            _, _, role, text = next(left)
            if letter == "K":
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif letter == "R":
                lines.append(f"{new}:{text}")
                state = rp.FOLLOW[state]
        known = {t[0][1] for t in turns if t[0][0]}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[
            conv, gaps, counts["blank"], counts["again"], counts["open"], illegal, cost, audit,
            sha("\n".join(lines)),
        ] += 1
    return out


def test_conversations_as_plain(spark):
    rng = random.Random(9)
    rows = []
    for c in [*range(120), -3, None]:
        for t in range(rng.choice([1, 2, 5, 9, 30])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "é! \t", " ", None, "", "x\ny?", f"only {c} {t}."])
            rows.append((c, rng.choice([t, t, t, t + 40, None]) if t else t, role, text))
    rows += [(900, t, "user", "all blank?" if t % 2 else "  ") for t in range(3000)]
    rows += [(901, t, "assistant", "long " * 60_000) for t in range(3)]
    rows += rows[:5]
    got = repaired_conversations(damaged(chat_frame(spark, rows).repartition(4)), copies="copies")
    assert Counter(map(tuple, got.collect())) == plain_conversations(rows)


def test_conversations_as_they_are(spark):
    rows = [(1, 0, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 0, "system", "Be kind.")]
    got = {r.conv_id: r for r in repaired_conversations(chat_frame(spark, rows)).collect()}
    assert (got[1].audit, got[1].cost, got[1].gaps) == ("KK", 0, 1)
    assert got[1].repaired_sha256 == sha("user:Hi.\nassistant:Hello.")
    assert (got[2].audit, got[2].cost, got[2].repaired_sha256) == ("D", 4, sha(""))


def test_conversations_of_nothing(spark):
    assert repaired_conversations(damaged(chat_frame(spark, []))).collect() == []


def test_extreme_turns(spark):
    rows = [(1, -(2**63), "user", "Hi."), (1, 2**63 - 1, "assistant", "So.")]
    got = repaired_conversations(chat_frame(spark, rows)).first()
    assert got.gaps == rp.LONGEST
