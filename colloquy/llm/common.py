"""What several operators share: scratch tables, hashing, packed exchanges and components.

Packed exchange.  Several operators need one global fact about every hash that a block of
documents holds (a count, "is it in another document").  A row for each hash would cost
tens of bytes in JVM rows, so a block sends one row for each bucket of the hash space,
holding its sorted distinct hashes in a packed form; the bucket's task merges the lists and
answers each block in the order of the list, so that answers carry no hashes.  A hash
appears once for each block however often it occurs, thus no key is hot.  A block sends
nothing to a bucket of which it has no hash: rows are at most the distinct hashes of the
blocks, however many blocks and buckets there are, and fewer by the packing where lists are
long.
"""

from __future__ import annotations

import gc

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from colloquy.sources.scratch import materialize

U64 = np.uint64
BLOCK_BYTES = 6 << 20


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- hashing
def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of the ordered pair (a, b), element by element."""
    with np.errstate(over="ignore"):
        x = (a ^ U64(0x9E3779B97F4A7C15)) * U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(29)
        x += b if isinstance(b, np.ndarray) else U64(b)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(32)
        return x


class Interner(dict):
    """word -> small integer, numbered as met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def hash_words(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, count=len(words))


def word_arrays(texts, lower: bool = False, end: bytes | None = None):
    """(ids of all words of all texts, offsets of the texts, hashes by id).

    Words are runs of bytes other than the ASCII white space 0x20 and 0x09-0x0D, which is
    what bytes.split() splits at; bytes.lower() changes A-Z only.  end: a word added to
    every text, which no text can contain (it may hold white space).
    """
    ids, offsets, intern = [], np.zeros(len(texts) + 1, np.int64), Interner()
    get = intern.__getitem__
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = (raw.lower() if lower else raw).split()
        if end is not None:
            words.append(end)
        ids.append(np.fromiter(map(get, words), np.int32, count=len(words)))
        offsets[k + 1] = offsets[k] + len(words)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return flat, offsets, hash_words(intern)


# ---------------------------------------------------------------- packed lists
def pack_sorted(h: np.ndarray) -> bytes:
    """Sorted distinct uint64: gaps in six bytes, the few larger ones in eight after them."""
    if not len(h):
        return b""
    gaps = np.empty_like(h)
    gaps[0], gaps[1:] = h[0], np.diff(h)
    top = U64((1 << 48) - 1)
    far = gaps >= top
    near = np.where(far, top, gaps).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return len(h).to_bytes(4, "little") + near.tobytes() + gaps[far].astype("<u8").tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, U64)
    n = int.from_bytes(data[:4], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 4).reshape(n, 6)
    gaps = wide.view("<u8").ravel().astype(U64)
    far = gaps == U64((1 << 48) - 1)
    if far.any():
        gaps[far] = np.frombuffer(data, "<u8", int(far.sum()), 4 + 6 * n)
    with np.errstate(over="ignore"):
        return np.cumsum(gaps, dtype=U64)


def pack_counts(c: np.ndarray) -> bytes:
    """Non-negative integers: one byte each, those over 254 in eight bytes after them."""
    c = c.astype(np.int64)
    big = c >= 255
    return np.where(big, 255, c).astype(np.uint8).tobytes() + c[big].astype("<i8").tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    c = np.frombuffer(data, np.uint8, n).astype(np.int64)
    big = c == 255
    if big.any():
        c[big] = np.frombuffer(data, "<i8", int(big.sum()), n)
    return c


def bucket_bounds(n_buckets: int) -> np.ndarray:
    """First hash of each bucket but the first: equal slices of the hash space."""
    return np.array([(b << 64) // n_buckets for b in range(1, n_buckets)], U64)


def cut(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where the buckets' slices of the sorted h begin and end: n_buckets + 1 positions."""
    return np.concatenate(([0], np.searchsorted(h, bucket_bounds(n_buckets)), [len(h)])).astype(np.int64)


# ---------------------------------------------------------------- blocks
def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def with_block(docs: DataFrame, n_blocks: int) -> DataFrame:
    """doc_id, text and the block of each row; a hot source or group spreads over all blocks."""
    return docs.select(
        F.pmod(F.xxhash64("doc_id", F.length("text"), F.lit(7)), F.lit(n_blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )


def block_counts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """(blocks of about block_bytes of text, buckets of the hash space): both follow the input."""
    n = max(1, -(-text_bytes(docs) // block_bytes))
    return n, max(16, n // 3)


# ---------------------------------------------------------------- groups
SALTS = 16


def join_spread(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """rows joined with table(key, ...), one row for each key, so that the rows of one key lie in up to SALTS tasks.

    Each row takes one of SALTS numbers by a hash of its column `by`; the table has a row for each.
    """
    salted = rows.withColumn("_s", F.pmod(F.xxhash64(by, F.lit(3)), F.lit(SALTS).cast("long")).cast("int"))
    return salted.join(table.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, "_s"]).drop("_s")


# ---------------------------------------------------------------- connected components
def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """edges (a, b) long -> (id, component): the smallest id reachable, for every id in edges.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each round points
    neighbours at the smallest known id, and the work of a round is linear in the edges.
    Smallest neighbours are partial aggregates, written before the joins that read them: a
    join then has two bare exchanges below it and one row for each id on one side, so that
    adaptive execution splits a hub's rows over tasks.  Each round is written to the shared
    folder; the loop ends when a round changes nothing.  Self loops keep an id that has no
    other edge.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    first = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    alone, now, mark = first.where("u = v").select(F.col("u").alias("id")), first.where("u > v"), None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = materialize(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v").distinct()
        )
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        # u points at its least, and so do the other neighbours of u
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        told = Observation()
        new = small.where("u > v").distinct().observe(told, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"))
        now = materialize(new)
        got = told.get
        if (got["n"], got["h"]) == mark:
            break
        mark = got["n"], got["h"]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("id")).distinct()
    return (
        now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        .unionByName(roots.select("id", F.col("id").alias("component")))
        .unionByName(alone.select("id", F.col("id").alias("component")))
        .groupBy("id").agg(F.min("component").alias("component"))
    )
