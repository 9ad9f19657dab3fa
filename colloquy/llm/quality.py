"""Quality classifier from weak labels.

Overlapping heuristics vote on every document (bad, good, or nothing).  Expectation-
maximisation over the counts of vote patterns estimates how often each heuristic votes what
for bad and for good documents, and so the posterior of each pattern; no labels are needed.
The posteriors are the soft labels of a linear scorer over hashed features of the text,
which judges all documents.  A document is rejected when the scorer's probability of good is
under the threshold.

The votes of all documents are counted; a pattern table has at most 3 ** heuristics rows, so
it may go to the driver.  The scorer is fitted on a sample of about train_docs documents
(those whose id hashes lowest), which is the bound of what the driver holds.

Defined cases: a null, empty or blank text gets no votes, its score is the prior, and it is
kept whatever the prior is; every other text is judged whole by the scorer, however short or long; repeated
rows are judged alike; ties of the threshold are kept; an empty table gives no rows; columns
other than doc_id and text are ignored by classify() and kept by keep_good().
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 4000
THRESHOLD = 0.5
DIM = 1 << 13
GRAM = 5  # length of the runs of character classes that are hashed
BAD, GOOD = 1, 2
HEURISTICS = ("symbols", "capitals", "variety", "short_words", "sentences", "separators", "digits", "stutter")
ROUNDS = 200
FEW = 12  # words; shorter texts are judged by marks, capitals and digits, as the rest needs a run of words

SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))


def _classes() -> bytes:
    """Character class by byte: other, lower, upper, digit, space, line end, stop, symbol, beyond ASCII."""
    table = bytearray(256)
    for marks, kind in ((bytes(range(97, 123)), 1), (CAPITALS, 2), (DIGITS, 3), (b" \t", 4), (b"\n\r", 5), (b".!?,;:'\"()-", 6), (SYMBOLS, 7), (bytes(range(128, 256)), 8)):
        for b in marks:
            table[b] = kind
    return bytes(table)


CLASS_OF = _classes()


def stutter(words: list[bytes]) -> float:
    """Share of the words that repeat the word before."""
    return sum(map(eq, words, words[1:])) / max(1, len(words))


def votes(text: str | None) -> tuple[int, ...]:
    """One vote of each heuristic: 0 nothing, 1 bad, 2 good.

    Texts of few words get votes on shares of characters and of separators only, and a bad one
    only from three marks on.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0,) * len(HEURISTICS)
    n, count = len(raw), lambda marks: len(raw) - len(raw.translate(None, marks))
    letters = max(1, count(LETTERS))
    vote = lambda x, bad, good: BAD if bad(x) else GOOD if good(x) else 0
    separators = sum(not w.isalnum() and len(w) == 1 and w[0] < 128 for w in words)
    if len(words) < FEW:
        few = lambda k, of, bad, good: vote(k / of, lambda x: k >= 3 and x > bad, lambda x: x < good)
        return (
            few(count(SYMBOLS), n, 0.04, 0.01), few(count(CAPITALS), letters, 0.4, 0.15), 0, 0, 0,
            few(separators, len(words), 0.15, 0.03), few(count(DIGITS), n, 0.25, 0.03), 0,
        )
    distinct = len(set(words))
    plain = [w for w in words if w.isalpha() or len(w) > 3]
    short = sum(len(w) <= 3 for w in plain) / max(1, len(plain))
    stops = count(b".!?") / len(words)
    bars = separators / len(words)
    return (
        vote(count(SYMBOLS) / n, lambda x: x > 0.04, lambda x: x < 0.01),
        vote(count(CAPITALS) / letters, lambda x: x > 0.4, lambda x: x < 0.15),
        vote(distinct / len(words) ** 0.9, lambda x: x < 0.25, lambda x: x > 0.5),
        vote(short, lambda x: x < 0.08, lambda x: x > 0.2),
        vote(stops, lambda x: x > 0.5 or x < 0.01, lambda x: 0.02 < x < 0.35),
        vote(bars, lambda x: x > 0.15, lambda x: x < 0.03),
        vote(count(DIGITS) / n, lambda x: x > 0.25, lambda x: x < 0.03),
        vote(stutter(words), lambda x: x > 0.2, lambda x: x < 0.05),
    )


def pattern_of(v) -> int:
    return sum(x * 3**k for k, x in enumerate(v))


def votes_of(pattern: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(len(HEURISTICS))]


def estimate(patterns: dict[int, int], rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """EM over pattern counts -> (pattern -> probability of good, [class bad/good, heuristic] share of good votes).

    Only given votes are evidence, so documents without votes get the prior.  The start, kept
    as a few pseudo-counts, says that a bad vote is rare on good documents and common on bad
    ones, as each kind of bad document is known to some heuristics only; it fixes which class
    is which.
    """
    if not patterns:
        return {}, np.empty((0, 0))
    keys = sorted(patterns)
    v = np.array([votes_of(p) for p in keys])
    n = np.array([patterns[p] for p in keys], float)
    given, good = (v > 0).astype(float), (v == GOOD).astype(float)
    start, strength = np.array([0.55, 0.97]), 5.0
    right = np.repeat(start[:, None], v.shape[1], 1)
    prior = np.array([0.15, 0.85])
    for _ in range(rounds):
        log = np.log(prior)[:, None] + np.log(right) @ good.T + np.log(1 - right) @ (given - good).T
        post = np.exp(log - log.max(0))
        post /= post.sum(0)
        part = post * n
        used = part * (given.any(1))  # the prior is that of documents with votes
        prior = (used.sum(1) + [1.5, 8.5]) / (used.sum() + 10)
        right = (part @ good + strength * start[:, None]) / (part @ given + strength)
    return dict(zip(keys, post[1].tolist())), right


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): hashed runs of character classes, square roots of their shares, and the share
    of stuttered words, in tenths, as one more feature that is hashed like them.  A text shorter than a
    run is filled up with spaces; a blank one has no features.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32)
    tenths = int(10 * stutter(words))
    raw = raw.ljust(GRAM).translate(CLASS_OF)
    c = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h = c[: len(c) - GRAM + 1].copy()
    for k in range(1, GRAM):
        h *= np.uint32(9)
        h += c[k : len(c) - GRAM + 1 + k]
    h *= np.uint32(2654435761)
    h >>= np.uint32(32 - 13)
    share = np.bincount(h, minlength=DIM) / len(h)
    share[(9**GRAM + tenths) * 2654435761 % 2**32 >> 19] += 0.25
    at = np.flatnonzero(share)
    return at.astype(np.uint16), np.sqrt(share[at]).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = 200, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by AdaGrad over the whole sample."""
    w, b = np.zeros(DIM), 0.0
    if not rows:
        return w, b
    at = np.concatenate([r[0] for r in rows]).astype(np.int64)
    val = np.concatenate([r[1] for r in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    mean = min(max(target.mean(), 1e-3), 1 - 1e-3)
    b = float(np.log(mean / (1 - mean)))
    seen, seen_b = np.full(DIM, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(row, val * w[at], len(rows)) + b
        err = (1 / (1 + np.exp(-z)) - target) / len(rows)
        g, gb = np.bincount(at, val * err[row], DIM) + decay * w, err.sum()
        seen += g * g
        seen_b += gb * gb
        w -= 0.5 * g / np.sqrt(seen)
        b -= 0.1 * gb / np.sqrt(seen_b)
    return w, b


def _vote(batches):
    for batch in batches:
        p = [pattern_of(votes(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32())], ["pattern"])


def _sample(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        f = [features(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([pattern_of(votes(t)) for t in texts], pa.int32()), pa.array([x.tobytes() for x, _ in f], pa.binary()), pa.array([y.tobytes() for _, y in f], pa.binary())],
            ["pattern", "at", "val"])


def _judge(post: dict[int, float], w: np.ndarray, b: float, threshold: float):
    def run(batches):
        for batch in batches:
            weak, score, blank = [], [], []
            for t in batch.column("text").to_pylist():
                weak.append(post[pattern_of(votes(t))])
                at, val = features(t)
                blank.append(not len(at))
                score.append(weak[-1] if blank[-1] else float(1 / (1 + np.exp(-(val @ w[at] + b)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.round(weak, 6), pa.float64()), pa.array(np.round(score, 6), pa.float64()), pa.array((np.asarray(score) < threshold) & ~np.asarray(blank, bool), pa.bool_())],
                [*batch.schema.names[:-1], "weak_good", "score", "rejected"])

    return run


def sample(docs: DataFrame, train_docs: int) -> DataFrame:
    """At most train_docs of the distinct rows (doc_id, text), by a hash of both.  Null and repeated ids are drawn as others are."""
    key = F.xxhash64("doc_id", "text")
    distinct = docs.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    share = min(1.0, 1.2 * train_docs / max(1, distinct))  # a little more than needed, of which the first are taken
    drawn = docs.select(key.alias("key"), "text").where(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    return drawn.groupBy("key").agg(F.first("text").alias("text")).orderBy("key").limit(train_docs).select("text")


def model(docs: DataFrame, train_docs: int = TRAIN_DOCS):
    """(posterior of each pattern, weights, bias) learned from docs(doc_id, text)."""
    counts = {r["pattern"]: r["n"] for r in docs.select("text").mapInArrow(_vote, "pattern int").groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    post, _ = estimate(counts)
    rows = sample(docs, train_docs).mapInArrow(_sample, "pattern int, at binary, val binary").collect()  # at most train_docs rows
    rows.sort(key=lambda r: (r["pattern"], r["at"], r["val"]))
    w, b = fit([(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["val"], np.float32)) for r in rows], np.array([post[r["pattern"]] for r in rows]))
    return post, w, b


def classify(docs: DataFrame, train_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text) -> doc_id, weak_good, score, rejected."""
    post, w, b = model(docs, train_docs)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_judge(post, w, b, threshold), "doc_id long, weak_good double, score double, rejected boolean")


def keep_good(docs: DataFrame, train_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rejected ones; columns stay."""
    post, w, b = model(docs, train_docs)
    text = docs.columns.index("text")

    def run(batches):
        judge = _judge(post, w, b, threshold)
        for batch in batches:
            only = pa.RecordBatch.from_arrays([batch.column(text)], ["text"])
            for got in judge([only]):
                yield batch.filter(pc.invert(got.column("rejected")))

    return docs.mapInArrow(run, docs.schema)
