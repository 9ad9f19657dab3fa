"""Substring dedup by recompression.

A document's words are symbols.  A round first names every maximal run of one symbol, then
every pair of neighbours whose left one is a left symbol and whose right one is a right
symbol, sides being drawn from the name.  Names are hashes of what they stand for, so all
tasks give one name to one content and a round moves no data.  A symbol's occurrence knows
the words that decided it; if a window holds them all, an equal window elsewhere holds the
same symbol at the same place.

Spark rounds then ask: which symbols are in more than one document (first exchange), and, for
windows all of whose symbols are, which word sequences start in a smaller document (second
exchange, by 128-bit fingerprints of the window's words).  A window that decides no symbol, as
within a long run, skips the first question, so nothing is lost.

Exchanges are packed (common.py): a block of documents sends a bucket of the hash space one
row, and none where it has no hash of the bucket, so that rows never outnumber hashes.

Defined cases: words are runs of bytes other than 0x20 and 0x09-0x0D; a null or empty text
has no words; texts under the window's length lose nothing; a very long text is one block's
whole; rows of one doc_id do not count against each other, and a null doc_id counts as larger
than all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C

WINDOW = 50
ROUNDS = 4
LONGEST = 12  # words of a symbol that a pair may make
LAST = np.iinfo(np.int64).max  # stands for a null doc_id

ASKED = "bucket int, block int, data binary, extra binary"
TOLD = "block int, bucket int, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _merge(head: np.ndarray, a, z, size):
    """Symbols from groups of neighbours that begin at head; bounds and sizes are joined."""
    at = np.flatnonzero(head)
    return at, np.minimum.reduceat(a, at), np.maximum.reduceat(z, at), np.add.reduceat(size, at)


def recompress(h: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS):
    """Words' hashes, and where documents end -> (name, a, z) of the symbols after the rounds.

    [a, z) are the words that decided the symbol.  Documents are kept apart by a symbol of
    its own after each, which takes part in nothing.
    """
    n = len(h)
    bar = np.zeros(n + len(ends), bool)
    bar[ends + np.arange(len(ends))] = True
    name = np.empty(len(bar), C.U64)
    name[~bar] = h
    name[bar] = C.mix(np.arange(len(ends)).astype(C.U64), 0xB)  # differs from its neighbours
    a = np.empty(len(bar), np.int64)
    a[~bar] = np.arange(n)
    a[bar] = ends - 1  # out of reach of any window on either side
    z = a + np.where(bar, 2, 1)
    size = np.ones(len(bar), np.int64)
    for k in range(rounds):
        # runs: deciding takes the neighbours on both sides
        wide_a = np.minimum(a, np.concatenate((a[:1] - 1, a[:-1])))
        wide_z = np.maximum(z, np.concatenate((z[1:], z[-1:])))
        head = np.ones(len(name), bool)
        head[1:] = (name[1:] != name[:-1]) | bar[1:]
        at, a, z, size = _merge(head, wide_a, wide_z, size)
        times = np.diff(np.append(at, len(name)))
        name, bar = name[at], bar[at]
        name = np.where(times > 1, C.mix(name, (times + 2 * k).astype(C.U64)), name)
        # pairs: a pair decides itself; a lone left symbol takes its right neighbour, a right one its left
        right = (C.mix(name, 0x51DE + k) & C.U64(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~bar[:-1] & ~bar[1:] & (size[:-1] + size[1:] <= LONGEST)
        second = np.concatenate(([False], joins[:-1]))
        lone = ~joins & ~second
        wide_a = np.where(lone & right, np.minimum(a, np.concatenate((a[:1] - 1, a[:-1]))), a)
        wide_z = np.where(lone & ~right, np.maximum(z, np.concatenate((z[1:], z[-1:]))), z)
        pair = C.mix(name[:-1], name[1:]) if len(name) > 1 else name[:0]
        at, a, z, size = _merge(~second, wide_a, wide_z, size)
        name = np.where(joins[at], np.append(pair, C.U64(0))[at], name[at])
        bar = bar[at]
    return name[~bar], a[~bar], z[~bar]


def fingerprints(h: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of the width words from each position; positions near the end hold nothing of use."""
    done, out, step, part = 0, None, 1, h
    while step <= width:
        if width & step:
            shifted = np.append(part[done:], part[:done]) if done else part
            out = shifted if out is None else C.mix(out, shifted)
            done += step
        step *= 2
        if step <= width:
            half = step // 2
            part = C.mix(part, np.append(part[half:], part[:half]))
    return out


class _Block:
    def __init__(self, table: pa.Table):
        self.doc_ids = table.column("doc_id").to_pylist()
        self.order = np.array([LAST if d is None else d for d in self.doc_ids], np.int64)
        self.texts = table.column("text").to_pylist()
        ids, self.offsets, words = C.word_arrays(self.texts)
        self.h = words[ids] if len(ids) else np.empty(0, C.U64)
        n, length = len(self.h), np.diff(self.offsets)
        starts = np.ones(n, bool)  # where a window fits
        room = np.repeat(self.offsets[1:], length) - np.arange(n)
        starts[room < WINDOW] = False
        self.at = np.flatnonzero(starts)
        self.doc = np.repeat(np.arange(len(length)), length)
        name, a, z = recompress(self.h, self.offsets[1:]) if n else (self.h, ids, ids)
        # symbols that some window of their document decides; a and z do not fall
        of = self.doc[np.maximum(a, 0)]
        begin = np.minimum(a, self.offsets[1:][of] - WINDOW)
        decided = (begin >= self.offsets[:-1][of]) & (z <= begin + WINDOW)
        self.a, self.z, self.of = a[decided], z[decided], of[decided]
        self.symbol, self.used = np.unique(name[decided], return_inverse=True)

    def windows(self, shared: np.ndarray):
        """Positions that may repeat, their distinct fingerprints (two hashes), which is whose, and each one's smallest document."""
        alone = np.append(0, np.cumsum(~shared[self.used]))
        first, last = np.searchsorted(self.a, self.at), np.searchsorted(self.z, self.at + WINDOW, "right")
        at = self.at[alone[np.maximum(first, last)] == alone[first]]
        if not len(at):
            return at, np.empty(0, C.U64), np.empty(0, C.U64), at, np.empty(0, np.int64)
        one = fingerprints(self.h)[at]
        two = fingerprints(C.mix(self.h, 0x2ED))[at]
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        head = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
        of = np.empty(len(at), np.int64)
        of[order] = np.cumsum(head) - 1
        least = np.full(int(head.sum()), LAST)
        np.minimum.at(least, of, self.order[self.doc[at]])
        return at, one[head], two[head], of, least


def _ask(key, n_buckets: int, h: np.ndarray, extra) -> pa.Table:
    at = C.cut(h, n_buckets)
    some = np.flatnonzero(at[1:] > at[:-1])
    return pa.table({
        "bucket": pa.array(some, pa.int32()), "block": pa.array([key[0].as_py()] * len(some), pa.int32()),
        "data": pa.array([C.pack_sorted(h[at[k] : at[k + 1]]) for k in some], pa.binary()),
        "extra": pa.array([extra(at[k], at[k + 1]) for k in some], pa.binary()),
    })


def _bits(right: pa.Table, h: np.ndarray, n_buckets: int) -> np.ndarray:
    at = C.cut(h, n_buckets)
    parts = dict(zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()))
    return np.concatenate([np.unpackbits(np.frombuffer(parts.get(k, b""), np.uint8), count=at[k + 1] - at[k]) for k in range(n_buckets)]).astype(bool)


def _ask_symbols(n_buckets: int):
    def ask(key, table):
        b = _Block(table)
        least, most = np.full(len(b.symbol), LAST), np.full(len(b.symbol), np.iinfo(np.int64).min)
        whose = b.order[b.of]
        np.minimum.at(least, b.used, whose)
        np.maximum.at(most, b.used, whose)
        several = least < most
        return _ask(key, n_buckets, b.symbol, lambda s, e: np.packbits(several[s:e]).tobytes())

    return ask


def _tell_shared(key, table):
    """A bit for each symbol: is it in several documents of a block, or in several blocks?

    Rows of one doc_id may lie in two blocks; that such a symbol is looked at costs time only.
    """
    hashes = [C.unpack_sorted(x) for x in table.column("data").to_pylist()]
    distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
    shared = np.bincount(at, minlength=len(distinct)) > 1
    ends = np.cumsum([0, *map(len, hashes)])
    for x, s, e in zip(table.column("extra").to_pylist(), ends, ends[1:]):
        shared[at[s:e]] |= np.unpackbits(np.frombuffer(x, np.uint8), count=e - s).astype(bool)
    return _tell(key, table, [shared[at[s:e]] for s, e in zip(ends, ends[1:])])


def _tell(key, table: pa.Table, bits) -> pa.Table:
    return pa.table({
        "block": table.column("block").cast(pa.int32()), "bucket": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
        "bits": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
    })


def _ask_windows(n_buckets: int):
    def ask(key, left, right):
        b = _Block(left)
        _, one, two, _, least = b.windows(_bits(right, b.symbol, n_buckets))
        narrow = np.uint32 if (least.max(initial=0) < 2**32 and least.min(initial=0) >= 0) else np.int64
        return _ask(key, n_buckets, one, lambda s, e: two[s:e].tobytes() + least[s:e].astype(narrow).tobytes())

    return ask


def _tell_repeated(key, table):
    """A bit for each fingerprint: does it start in a smaller document than the block's smallest?"""
    one = [C.unpack_sorted(x) for x in table.column("data").to_pylist()]
    extra = table.column("extra").to_pylist()
    two = [np.frombuffer(x, C.U64, len(h)) for x, h in zip(extra, one)]
    least = [np.frombuffer(x, np.uint32 if len(x) == 12 * len(h) else np.int64, offset=8 * len(h)).astype(np.int64) for x, h in zip(extra, one)]
    ends = np.cumsum([0, *map(len, one)])
    one, two, every = np.concatenate(one), np.concatenate(two), np.concatenate(least)
    order = np.lexsort((two, one))
    head = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))
    at = np.empty(len(one), np.int64)
    at[order] = np.cumsum(head) - 1
    first = np.minimum.reduceat(every[order], np.flatnonzero(head))
    return _tell(key, table, [first[at[s:e]] < x for x, s, e in zip(least, ends, ends[1:])])


def removed_words(b: _Block, shared: np.ndarray, earlier) -> np.ndarray:
    """Which words go.  earlier(prints): a bit for each fingerprint of the block."""
    at, one, _, of, least = b.windows(shared)
    gone = earlier(one)[of] | (least[of] < b.order[b.doc[at]]) if len(at) else np.zeros(0, bool)
    edge = np.zeros(len(b.h) + 1, np.int64)
    np.add.at(edge, at[gone], 1)
    np.add.at(edge, at[gone] + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _finish(n_buckets: int):
    def finish(key, left, right):
        b = _Block(left)
        second = np.asarray(right.column("round").to_pylist()) == 2
        shared = _bits(right.filter(pa.array(~second)), b.symbol, n_buckets)
        gone = removed_words(b, shared, lambda prints: _bits(right.filter(pa.array(second)), prints, n_buckets))
        hashes = []
        for k, text in enumerate(b.texts):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            mask = gone[b.offsets[k] : b.offsets[k + 1]]
            hashes.append(hashlib.sha256(b" ".join(compress(words, ~mask) if mask.any() else words)).hexdigest())
        return pa.table({
            "doc_id": pa.array(b.doc_ids, pa.int64()), "n_words": pa.array(np.diff(b.offsets), pa.int64()),
            "n_removed": pa.array(np.diff(np.concatenate(([0], np.cumsum(gone)))[b.offsets]), pa.int64()),
            "kept_sha256": pa.array(hashes, pa.string()),
        })

    return finish


def dedup(docs: DataFrame, block_bytes: int = C.BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text) -> for each row its words, how many go, and the hash of what is kept."""
    spark = docs.sparkSession
    n_blocks, n_buckets = C.block_counts(docs, block_bytes)
    blocks = C.with_block(docs, n_blocks)
    asked = blocks.groupBy("block").applyInArrow(_ask_symbols(n_buckets), ASKED)
    shared = C.materialize(asked.groupBy("bucket").applyInArrow(_tell_shared, TOLD))
    del asked
    C.release(spark)
    asked = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_ask_windows(n_buckets), ASKED)
    repeated = C.materialize(asked.groupBy("bucket").applyInArrow(_tell_repeated, TOLD))
    del asked
    C.release(spark)
    told = shared.withColumn("round", F.lit(1)).unionByName(repeated.withColumn("round", F.lit(2)))
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_finish(n_buckets), RESULT)
