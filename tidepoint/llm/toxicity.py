"""Toxicity by a linear-chain conditional random field over the words of a text.

Training needs labelled tokens, but labels mark documents. A token counts as toxic if its
document does and one of its features (the word, its prefixes) occurs in toxic documents far
more often than chance allows among as many features; the test is a likelihood ratio against
the logarithm of their number. The field has two states; its emission weights are hashed
features of the word. Emissions and transitions are learnt together, by gradient ascent on the
likelihood, from the marginals of states and of pairs of states that forward-backward gives. A logistic function of the marginals, fitted on
other labelled documents than the field, gives the score of a document.

The model is fitted on the driver from a bounded sample: at most ``TOXIC_ROWS`` toxic and
``OTHER_ROWS`` other labelled documents, the first by a hash of their id whose texts fit in
``TOXIC_BYTES`` and ``OTHER_BYTES``. Of training segments without a toxic token and without a
feature of one, one in ``EASY_SHARE`` is used. The model has 2**20 weights, whatever the input.
Scoring runs over whole texts of all documents in Arrow batches.

Defined cases: a null or empty text has no words and gets the score of no evidence; without
labels of both kinds every score is the share of toxic labels, or 0; a repeated label counts
once, the largest; null labels are left out; repeated rows are scored each; an empty table
gives no rows. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.session import pin

TOXIC_ROWS = 1500
OTHER_ROWS = 3000
TOXIC_BYTES = 16 << 20
OTHER_BYTES = 32 << 20
EASY_SHARE = 8
BITS = 20
PREFIXES = (3, 4, 5, 6)
SEGMENT = 64  # tokens of a training sequence
STEPS = 40
CACHE = 300_000
PAIRS = 1 << 18  # pairs of states held at a time in training
PREDICT_AT = 0.7
EXPLAINED = 0.25  # of the strongest feature's ratio in a document, below which others are chance

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?\"'()[]{}|#*$%&<>-_/\\"


def features(word: str) -> list[int]:
    """Hashed features: the bare word in lower case and its prefixes."""
    bare = word.lower().strip(_EDGES)
    names = [f"w:{bare}", *(f"{k}:{bare[:k]}" for k in PREFIXES if len(bare) > k)]
    return [zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names]


def _log_ratio(x: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """log((e**x * up[1] + up[0]) / (e**x * down[1] + down[0])) for bounded x."""
    e = np.exp(x)
    return np.log((e * up[1] + up[0]) / (e * down[1] + down[0]))


def marginals(scores: np.ndarray, offsets: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """Log odds of the toxic state at each token, by forward-backward.

    ``scores``: emission log odds of all tokens of all sequences; ``offsets``: where each
    sequence begins; ``jump``: 2x2 factors, from row to column. Messages are kept as log odds.
    All sequences advance together, the longest first, so a step works on a slice.
    """
    forward, backward = messages(scores, offsets, jump)
    return forward + backward


def messages(
    scores: np.ndarray, offsets: np.ndarray, jump: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each token's state from its own score and those before, and from after."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = offsets[:-1][order], lengths[order]
    forward, backward = np.zeros(len(scores)), np.zeros(len(scores))
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    f = np.zeros(len(lengths))
    for t in range(longest):
        k = active[t]
        at = begin[:k] + t
        f = scores[at] + (_log_ratio(f[:k], jump[:, 1], jump[:, 0]) if t else 0.0)
        np.clip(f, -60, 60, out=f)
        forward[at] = f
    last = np.zeros(len(lengths))
    for t in range(longest - 2, -1, -1):
        k = active[t + 1]
        at = begin[:k] + t
        ahead = np.clip(scores[at + 1] + last[:k], -60, 60)
        last[:k] = _log_ratio(ahead, jump[1], jump[0])
        backward[at] = last[:k]
    return forward, backward


def pair_marginals(
    scores: np.ndarray, forward: np.ndarray, backward: np.ndarray, jump: np.ndarray, second: np.ndarray
) -> np.ndarray:
    """Probability of each pair of states of ``second`` tokens and those before: ``n, 2, 2``."""
    left = forward[second - 1]
    right = np.clip(scores[second] + backward[second], -60, 60)
    logs = np.log(jump) + left[:, None, None] * np.array([[0, 0], [1, 1]])
    logs = logs + right[:, None, None] * np.array([[0, 1], [0, 1]])
    logs -= logs.max(axis=(1, 2), keepdims=True)
    weights = np.exp(logs)
    return weights / weights.sum(axis=(1, 2), keepdims=True)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Crf:
    """Weights of the field and of the score."""

    def __init__(self):
        self.weights = np.zeros(1 << BITS)
        self.bias = -3.0
        self.jump = np.zeros((2, 2))  # logarithms
        self.score = np.array([0.0, 0.0, 0.0])
        self.constant: float | None = None
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "weights": self.weights.astype(np.float32)}

    def emission(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            value = self.bias + float(self.weights[features(word)].sum())
            self.known[word] = value = max(-30.0, min(30.0, value))
        return value

    def token_odds(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [_WORD.findall(text) for text in texts]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        emission = self.emission
        scores = np.fromiter((emission(x) for w in words for x in w), float, offsets[-1])
        return marginals(scores, offsets, np.exp(self.jump)), offsets

    @staticmethod
    def evidence(odds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: log odds of its surest token, and the log of its expected toxic tokens."""
        rows = np.zeros((len(offsets) - 1, 2))
        rows[:, 0] = -10.0
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            starts = offsets[:-1][full]
            rows[full, 0] = np.clip(np.maximum.reduceat(odds, starts), -10, 10)
            # Tokens that are almost surely clean add nothing, however many they are.
            sure = np.where(odds > 0, _sigmoid(odds), 0.0)
            rows[full, 1] = np.log1p(np.add.reduceat(sure, starts))
        return rows

    def scores(self, odds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        return _sigmoid(self.score[0] + self.evidence(odds, offsets) @ self.score[1:])


class Tokens:
    """Features of the tokens of some texts, cut into training segments, in flat arrays."""

    def __init__(self, texts: list[str]):
        flat, sizes, owner, offsets = array("i"), array("b"), array("i"), [0]
        memory: dict[str, list[int]] = {}
        for d, text in enumerate(texts):
            found = _WORD.findall(text)
            for begin in range(0, len(found), SEGMENT):
                for word in found[begin : begin + SEGMENT]:
                    own = memory.get(word)
                    if own is None:
                        if len(memory) >= CACHE // 4:
                            memory.clear()
                        own = memory[word] = features(word)
                    flat.extend(own)
                    sizes.append(len(own))
                    owner.append(d)
                offsets.append(len(sizes))
        self.flat, self.sizes = np.array(flat, np.int32), np.array(sizes, np.int64)
        self.owner, self.offsets = np.array(owner, np.int32), np.array(offsets)

    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def keep(self, segments: np.ndarray) -> np.ndarray:
        """Drop the other segments; returns which tokens stay."""
        lengths = np.diff(self.offsets)
        token = np.repeat(segments, lengths)
        self.flat = self.flat[np.repeat(token, self.sizes)]
        self.sizes, self.owner = self.sizes[token], self.owner[token]
        self.offsets = np.concatenate([[0], np.cumsum(lengths[segments])])
        return token


def token_labels(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents with a feature that chance does not explain."""
    n, n1 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    starts = tokens.starts()
    edges = np.searchsorted(tokens.owner, np.arange(len(toxic) + 1))
    places = np.append(starts, len(tokens.flat))[edges]
    for d, (i, j) in enumerate(zip(places[:-1], places[1:])):
        own = np.unique(tokens.flat[i:j])
        n[own] += 1
        n1[own] += toxic[d]
    share = toxic.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        p = n1 / n
        ratio = n1 * np.log(p / share)
        ratio += np.where(n > n1, (n - n1) * np.log((1 - p) / (1 - share)), 0.0)
    marks = (n1 > 0) & (p >= 0.8) & (ratio > np.log(max(2, (n > 0).sum())))
    ratio = np.where(marks, ratio, 0.0).astype(np.float32)
    best = np.maximum.reduceat(ratio[tokens.flat], starts)
    # What is toxic explains the words that copies of a toxic document happen to share.
    top = np.zeros(len(toxic), np.float32)
    np.maximum.at(top, tokens.owner, best)
    hit = (best > 0) & (best >= EXPLAINED * top[tokens.owner])
    return (hit & (toxic[tokens.owner] > 0)).astype(float)


def fit(texts: list[str], toxic: np.ndarray) -> Crf:
    """The field from two thirds of the texts, its score from the rest."""
    model = Crf()
    if len(texts) < 3 or toxic.min() == toxic.max():
        model.constant = float(toxic.mean()) if len(texts) else 0.0
        return model
    own = np.arange(len(texts)) % 3 < 2
    if toxic[own].min() == toxic[own].max() or toxic[~own].min() == toxic[~own].max():
        own = np.ones(len(texts), bool)
    chosen = np.flatnonzero(own)
    tokens = Tokens([texts[i] for i in chosen])
    labels = token_labels(tokens, toxic[chosen]) if len(tokens.sizes) else np.zeros(0)
    if not labels.any():
        model.constant = float(toxic.mean())
        return model
    # Of segments without a toxic token, those count that have a feature of one in another
    # word; the rest are many and alike, and a fixed share of them is enough.
    telling = np.zeros(1 << BITS, bool)
    telling[tokens.flat[np.repeat(labels > 0, tokens.sizes)]] = True
    hard = np.logical_or.reduceat(telling[tokens.flat], tokens.starts())
    heads = tokens.offsets[:-1]
    segments = np.logical_or.reduceat(hard, heads) | (
        np.arange(len(heads)) % EASY_SHARE == 0
    )
    labels = labels[tokens.keep(segments)]
    _train(model, tokens, labels)
    rest = np.flatnonzero(~own) if not own.all() else chosen
    odds, at = model.token_odds([texts[i] for i in rest])
    _calibrate(model, model.evidence(odds, at), toxic[rest])
    model.known = {}
    return model


def _train(model: Crf, tokens: Tokens, labels: np.ndarray) -> None:
    """Gradient ascent with per-weight step sizes on the penalised likelihood."""
    flat, offsets, n = tokens.flat, tokens.offsets, len(labels)
    token = np.repeat(np.arange(n, dtype=np.int32), tokens.sizes)
    inner = np.ones(n, bool)
    inner[offsets[:-1]] = False
    second = np.flatnonzero(inner)
    before = labels[second - 1].astype(int)
    after = labels[second].astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (before, after), 1.0)
    # A start from the labels' own frequencies; the factor of two clean states stays one.
    rows = (seen + 1) / (seen + 1).sum(axis=1, keepdims=True)
    model.jump = np.log(rows)
    model.jump -= model.jump[0, 0]
    power = np.full(1 << BITS, 1e-3)
    power_bias, power_jump = 1e-3, np.full((2, 2), 1e-3)
    for _ in range(STEPS):
        scores = np.clip(model.bias + np.bincount(token, model.weights[flat], n), -30, 30)
        factors = np.exp(model.jump)
        forward, backward = messages(scores, offsets, factors)
        miss = labels - _sigmoid(forward + backward)
        lean = jump_gradient(seen, scores, forward, backward, factors, second) - 0.02 * model.jump
        lean[0, 0] = 0.0
        power_jump += lean**2
        model.jump = np.clip(model.jump + 0.1 * lean / np.sqrt(power_jump), -20, 20)
        gradient = np.bincount(flat, miss[token], 1 << BITS) - 0.02 * model.weights
        power += gradient**2
        model.weights += 0.7 * gradient / np.sqrt(power)
        power_bias += miss.sum() ** 2
        model.bias += 0.2 * miss.sum() / np.sqrt(power_bias)


def jump_gradient(
    seen: np.ndarray,
    scores: np.ndarray,
    forward: np.ndarray,
    backward: np.ndarray,
    factors: np.ndarray,
    second: np.ndarray,
) -> np.ndarray:
    """Pairs of states as labelled less as expected: the slope of the log likelihood."""
    expected = np.zeros((2, 2))
    for part in np.array_split(second, max(1, len(second) // PAIRS + 1)):
        expected += pair_marginals(scores, forward, backward, factors, part).sum(axis=0)
    return seen - expected


def _calibrate(model: Crf, evidence: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic regression by Newton steps, lightly penalised."""
    rows = np.column_stack([np.ones(len(evidence)), evidence])
    w = np.zeros(3)
    for _ in range(30):
        p = _sigmoid(rows @ w)
        hessian = rows.T @ (rows * (p * (1 - p))[:, None]) + 0.05 * np.eye(3)
        w += np.linalg.solve(hessian, rows.T @ (toxic - p) - 0.05 * w)
    model.score = w


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int,
    other_rows: int,
    toxic_bytes: int = TOXIC_BYTES,
    other_bytes: int = OTHER_BYTES,
) -> tuple[list[str], np.ndarray]:
    """A sample of labelled texts, bounded in rows and bytes, outside the held-out third."""
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    known = (
        labels.where(train & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts, marks = [], []
    limits = ((1, toxic_rows, toxic_bytes), (0, other_rows, other_bytes))
    for value, limit, most in limits:
        first = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id")
        first = pin(first.limit(limit).select(F.col("doc_id").alias("id")))
        here = F.col("doc_id") == F.col("id")
        # Sizes first, a row per document of the sample, so that the texts fetched are bounded.
        sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
        sizes = sizes.join(F.broadcast(first), here).groupBy("doc_id").agg(F.sum("n").alias("n"))
        chosen, left = [], most
        for row in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
            if row.n <= left:
                chosen.append((row.doc_id,))
                left -= row.n
        ids = docs.sparkSession.createDataFrame(chosen, first.schema)
        rows = docs.select("doc_id", "text").join(F.broadcast(ids), here)
        rows = sorted((r.doc_id, r.text or "") for r in rows.select("doc_id", "text").collect())
        rows.sort(key=lambda r: zlib.crc32(str(r[0]).encode()))
        texts += [text for _, text in rows]
        marks += [value] * len(rows)
    return texts, np.array(marks, float)


def train(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    other_rows: int = OTHER_ROWS,
) -> Crf:
    return fit(*training_rows(docs, labels, toxic_rows, other_rows))


def toxic_scores(docs: DataFrame, model: Crf) -> DataFrame:
    """A row per document: ``doc_id, held_out, score, predicted, spans``.

    ``spans``: ``start:end`` in code points of neighbouring words that are toxic rather than
    not, comma-joined.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spans(text: str, odds: np.ndarray) -> str:
        found: list[list[int]] = []
        previous = False
        for match, odd in zip(_WORD.finditer(text), odds):
            if odd > 0:
                if previous:
                    found[-1][1] = match.end()
                else:
                    found.append([match.start(), match.end()])
            previous = odd > 0
        return ",".join(f"{a}:{b}" for a, b in found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            odds, offsets = model.token_odds(texts)
            score = model.scores(odds, offsets)
            marks = []
            for text, i, j in zip(texts, offsets[:-1], offsets[1:]):
                own = odds[i:j]
                marks.append(spans(text, own) if len(own) and own.max() > 0 else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(marks, pa.string())],
                ["doc_id", "score", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, spans string"
    )
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
        "spans",
    )
