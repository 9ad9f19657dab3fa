"""Language-model scoring by deleted interpolation.

The model mixes three estimates of a token w after a token h: the bigram's maximum
likelihood c(h w)/c(h), the unigram's c(w)/N and the uniform 1/(V+1).  The weights depend on
the bucket of the context's frequency (floor(log2 c(h)), unseen apart) and are learned by
expectation-maximisation on held-out counts: a fold of the training documents is deleted
from the counts and its tokens are the evidence.  Scoring then uses the counts of all
training documents with these weights.

Every count covers all training documents.  Counts travel as packed exchanges (common.py):
a block of documents sends its distinct n-grams once and is told their totals.

Defined cases: a null or empty text is its end token alone; a very long text is scored whole,
as a block of its own size; a null doc_id counts as the text
"" in the folds; repeated rows are documents of their own; an empty table gives no rows; a
corpus without training documents scores by the uniform estimate; columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C

END = b"\n"  # no word holds white space
FOLDS, TEST_FOLD, DEV_FOLD = 7, 2, 3
N_CONTEXTS = 24  # unseen, then floor(log2 c(h)), the last open
RESOLUTION = 4  # cells of an octave in which the evidence is summed
ROUNDS = 40

SENT = "bucket int, block int, data binary, counts binary"
TOLD = "block int, bucket int, dev binary, total binary, tokens long, types long, left_tokens long"
CELLS = "context int, r1 int, r2 int, n double, p0 double, p1 double, p2 double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fold_of(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


class _Block:
    """The tokens of a block's documents, and its distinct n-grams as sorted 64-bit hashes.

    The lowest bit tells a unigram (0) from a bigram (1).  The context of a document's first
    token is the end token of no document, so c(END) is the number of documents for both.
    """

    def __init__(self, table: pa.Table):
        self.doc_ids = table.column("doc_id").to_pylist()
        self.ids, self.offsets, words = C.word_arrays(table.column("text").to_pylist(), lower=True, end=END)
        self.folds = np.array([fold_of(d) for d in self.doc_ids], np.int64)
        one = C.U64(1)
        self.uni = words & ~one
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        before[self.offsets[:-1]] = self.ids[self.offsets[1:] - 1]  # every text ends with END
        pairs = before.astype(np.int64) * len(words) + self.ids
        pairs, self.pair_of = np.unique(pairs, return_inverse=True)
        self.bi = C.mix(words[pairs // len(words)], words[pairs % len(words)]) | one
        self.before = before
        every = np.concatenate((self.uni, self.bi))
        order = np.argsort(every, kind="stable")
        self.sorted = every[order]
        self.place = np.empty(len(order), np.int64)  # of each n-gram in the sorted list
        self.place[order] = np.arange(len(order))

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_ids)), np.diff(self.offsets))

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Of the sorted n-grams, over the tokens in mask."""
        uni = np.bincount(self.ids[mask], minlength=len(self.uni))
        bi = np.bincount(self.pair_of[mask], minlength=len(self.bi))
        out = np.empty(len(self.sorted), np.int64)
        out[self.place[: len(uni)]], out[self.place[len(uni) :]] = uni, bi
        return out

    def of_tokens(self, told: np.ndarray):
        """c(w), c(h), c(h w) of each token from the counts of the sorted n-grams."""
        uni, bi = told[self.place[: len(self.uni)]], told[self.place[len(self.uni) :]]
        return uni[self.ids], uni[self.before], bi[self.pair_of]


def _send(n_buckets: int):
    def send(key, table):
        b = _Block(table)
        c = b.counts((b.folds != TEST_FOLD)[b.doc_of()])
        at = C.cut(b.sorted, n_buckets)
        some = np.flatnonzero(at[1:] > at[:-1])
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "block": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "data": pa.array([C.pack_sorted(b.sorted[at[k] : at[k + 1]]) for k in some], pa.binary()),
            "counts": pa.array([C.pack_counts(c[at[k] : at[k + 1]]) for k in some], pa.binary()),
        })

    return send


def _total(n_dev: int):
    """Adds the blocks' counts; answers with totals, and for blocks of the deleted fold with what is left."""

    def total(key, table):
        blocks = table.column("block").to_pylist()
        hashes = [C.unpack_sorted(x) for x in table.column("data").to_pylist()]
        counts = [C.unpack_counts(x, len(h)) for x, h in zip(table.column("counts").to_pylist(), hashes)]
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        sums, deleted = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        ends = np.cumsum([0, *map(len, hashes)])
        for b, c, s, e in zip(blocks, counts, ends, ends[1:]):
            sums[at[s:e]] += c
            if b < n_dev:
                deleted[at[s:e]] += c
        uni = (distinct & C.U64(1)) == 0
        left = sums - deleted
        told = [C.pack_counts(sums[at[s:e]]) for s, e in zip(ends, ends[1:])]
        kept = [C.pack_counts(left[at[s:e]]) if b < n_dev else None for b, s, e in zip(blocks, ends, ends[1:])]
        facts = {"tokens": int(sums[uni].sum()), "types": int((sums[uni] > 0).sum()), "left_tokens": int(left[uni].sum())}
        k = len(blocks)
        return pa.table({
            "block": pa.array([*blocks, -1], pa.int32()), "bucket": pa.array([key[0].as_py()] * (k + 1), pa.int32()),
            "dev": pa.array([*kept, None], pa.binary()), "total": pa.array([*told, None], pa.binary()),
        } | {c: pa.array([None] * k + [x], pa.int64()) for c, x in facts.items()})

    return total


def _told(b: _Block, right: pa.Table, column: str, n_buckets: int) -> np.ndarray:
    at = C.cut(b.sorted, n_buckets)
    parts = dict(zip(right.column("bucket").to_pylist(), right.column(column).to_pylist()))
    return np.concatenate([C.unpack_counts(parts.get(k, b""), at[k + 1] - at[k]) for k in range(n_buckets)])


def _context(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64) + 1, N_CONTEXTS - 1), 0)


def _estimates(cw, ch, chw, n: int, v: int):
    p0 = np.full(len(cw), 1 / (v + 1))
    return p0, cw / max(n, 1), chw / np.maximum(ch, 1)


def _cells(n_buckets: int, n_left: int, v: int):
    """The deleted fold's tokens, summed in cells of context bucket and rounded ratios of the estimates."""

    def cells(key, left, right):
        kinds = dict(zip(CELLS.replace(",", "").split()[::2], [pa.int32()] * 3 + [pa.float64()] * 4))
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        b = _Block(left)
        kept = _told(b, right, "dev", n_buckets)
        cw, ch, chw = b.of_tokens(kept)
        p0, p1, p2 = _estimates(cw, ch, chw, n_left, v)
        r = [np.where(p > 0, np.round(RESOLUTION * np.log2(np.maximum(p, 1e-300) / p0)), -999).astype(np.int64) for p in (p1, p2)]
        code = (_context(ch) * 2048 + r[0] + 1024) * 2048 + r[1] + 1024
        code, at = np.unique(code, return_inverse=True)
        sums = [np.bincount(at, w) for w in (np.ones(len(at)), p0, p1, p2)]
        cols = [code >> 22, (code >> 11) % 2048 - 1024, code % 2048 - 1024, *sums]
        return pa.table({k: pa.array(x, t) for (k, t), x in zip(kinds.items(), cols)})

    return cells


def learn_weights(cells: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """EM over the cells (context, n, mean p0, p1, p2) -> weights[context] of (p0, p1, p2).

    Contexts without evidence take the weights of the nearest seen context; an unseen
    context gives the bigram no weight, its share going to the other two.
    """
    weights = np.tile([0.1, 0.4, 0.5], (N_CONTEXTS, 1))
    weights[0] = [0.2, 0.8, 0.0]
    if not len(cells):
        return weights
    context, n, p = cells[:, 0].astype(int), cells[:, 1], cells[:, 2:]
    for _ in range(rounds):
        part = weights[context] * p
        part *= (n / part.sum(1))[:, None]
        sums = np.stack([np.bincount(context, part[:, j], N_CONTEXTS) for j in range(3)], 1)
        sums += [0.5, 0.0, 0.0]  # the uniform share never falls to nothing
        weights = sums / sums.sum(1, keepdims=True)
        weights[0, 2] = 0.0
        weights[0] /= weights[0].sum()
    seen = np.unique(context[context > 0])
    for k in range(1, N_CONTEXTS):
        if len(seen) and k not in seen:
            weights[k] = weights[seen[np.abs(seen - k).argmin()]]
    return weights


def _score(n_buckets: int, n: int, v: int, weights: np.ndarray):
    def score(key, left, right):
        b = _Block(left)
        cw, ch, chw = b.of_tokens(_told(b, right, "total", n_buckets))
        base = np.log10((cw + 1) / (n + v + 1))
        w = weights[_context(ch)]
        p0, p1, p2 = _estimates(cw, ch, chw, n, v)
        model = np.log10(w[:, 0] * p0 + w[:, 1] * p1 + w[:, 2] * p2)
        starts = b.offsets[:-1]
        k = len(b.doc_ids)
        return pa.table({
            "doc_id": pa.array(b.doc_ids, pa.int64()), "held_out": pa.array(b.folds == TEST_FOLD),
            "n_tokens": pa.array(np.diff(b.offsets), pa.int64()), "n_known": pa.array(np.add.reduceat((cw > 0).astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array([n] * k, pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, starts)), "score": pa.array(np.add.reduceat(model, starts)),
        })

    return score


def _in_blocks(docs: DataFrame, n_blocks: int, n_dev: int) -> DataFrame:
    """Blocks below n_dev hold the deleted fold, the others the rest."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    key = F.xxhash64("doc_id", F.length("text"), F.lit(7))
    block = F.when(fold == DEV_FOLD, F.pmod(key, F.lit(n_dev))).otherwise(F.pmod(key, F.lit(n_blocks - n_dev)) + n_dev)
    return docs.select(block.cast("int").alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def score(docs: DataFrame, block_bytes: int = C.BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text) -> a row for each with its base and model log10 probability."""
    spark = docs.sparkSession
    n_blocks, n_buckets = C.block_counts(docs, block_bytes)
    n_dev = -(-n_blocks // FOLDS)
    n_blocks += n_dev
    blocks = _in_blocks(docs, n_blocks, n_dev)
    sent = blocks.groupBy("block").applyInArrow(_send(n_buckets), SENT)
    told = C.materialize(sent.groupBy("bucket").applyInArrow(_total(n_dev), TOLD))
    del sent
    C.release(spark)
    n, v, n_left = (x or 0 for x in told.where("block = -1").agg(F.sum("tokens"), F.sum("types"), F.sum("left_tokens")).first())
    in_dev = docs.where(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == DEV_FOLD)
    dev_docs = _in_blocks(in_dev, n_blocks, n_dev)
    dev_told = told.where(f"block >= 0 and block < {n_dev}").select("block", "bucket", "dev")
    cells = (
        dev_docs.groupBy("block").cogroup(dev_told.groupBy("block")).applyInArrow(_cells(n_buckets, n_left, v), CELLS)
        .groupBy("context", "r1", "r2").agg(*[F.sum(c).alias(c) for c in ("n", "p0", "p1", "p2")])
        .orderBy("context", "r1", "r2").collect()  # bounded: contexts times the two ranges of rounded ratios
    )
    C.release(spark)
    weights = learn_weights(np.array([[c.context, c.n, c.p0 / c.n, c.p1 / c.n, c.p2 / c.n] for c in cells]))
    total = told.where("block >= 0").select("block", "bucket", "total")
    return blocks.groupBy("block").cogroup(total.groupBy("block")).applyInArrow(_score(n_buckets, n, v, weights), SCORES)
