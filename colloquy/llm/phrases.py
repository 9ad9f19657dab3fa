"""Phrase collocation mining: mergeable Misra-Gries summaries, then exact counts.

Texts are lower-cased (A-Z), cut into pieces and words; phrases are one to three words of a
piece, counted for each language.  Two passes:

1. A block of documents sends each partition of the hash space its distinct phrases, hashed to
   48 bits, with their counts.  The partition merges these into one Misra-Gries summary, whose
   capacity exceeds the partition's mass divided by the threshold: what the summary subtracts
   from any counter is then below the threshold, so every phrase that reaches it survives.
   Hash collisions only add to a counter, thus they can keep a phrase but never lose one.  Each
   block is told in a bit for each of its phrases which survived.
2. Blocks count their surviving phrases by their words, and Spark sums the counts by
   language and phrase: these are exact, and what is below the threshold goes.

A candidate's parts occur at least as often as the candidate, so they are among the counted
ones.  Scores are integers of 38 digits (`a` below 10^16).  The first ranks of a language are
chosen in two steps, in shares of its candidates and then among the shares' first ones.

Hot keys: a very common phrase is a row for each block; joins on the parts of candidates
have bare exchanges below them, so that adaptive execution splits a very common first word.
A language may hold all rows: blocks follow a hash of the document, ranks are drawn in shares.

Defined cases: a null or blank text has no words; a null language is `und`, as is the
language of that name; an empty table gives no rows; a language without candidates gives
none; a very long text is one document of its block; repeated rows count as often as they
occur; documents without ids are dealt by their texts, so equal ones share a block; ties go by score, a and the phrase's
bytes; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm import common as C
from colloquy.llm import words as W

THRESHOLD = 10
MOST_WORDS = 3
FIRST = 2000
SCALE = 1_000_000
COVER = (50, 100)  # a phrase goes if a longer one holds this share of it, as a fraction
UNKNOWN = "und"
BLOCK_BYTES = 6 << 20
SHARE_ROWS = 100_000  # candidates of a share when ranks are drawn
BITS = 48

#: A-Z to a-z, tabs to spaces, everything that ends a piece to the line feed.
FOLD = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)

SENT = "bucket int, block int, data binary, counts binary"
ALIVE = "block int, bucket int, alive binary"
COUNTED = "lang string, phrase string, size int, n long"


# ---------------------------------------------------------------- summaries
class Summary:
    """A Misra-Gries summary of (hash, count) pairs, mergeable, with the given number of counters.

    lost is what has been subtracted from every counter at most; it is below
    mass / (capacity + 1), so an item of frequency f has a counter of f - lost at least.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._rows = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((hashes, counts))
        self._rows += len(hashes)
        if self._rows > 2 * self.capacity:
            self.settle()

    def merge(self, other: Summary) -> None:
        other.settle()
        self.lost += other.lost
        self.add(other.hashes, other.counts)

    def settle(self) -> None:
        """Adds what waits; beyond the capacity the largest counter left over is subtracted from all."""
        if not self._waiting:
            return
        every = np.concatenate([self.hashes, *(h for h, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting, self._rows = [], 0
        order = np.argsort(every, kind="stable")
        every = every[order]
        heads = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
        self.hashes, self.counts = every[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts[:0]
        over = len(self.counts) - self.capacity
        if over > 0:
            least = int(np.partition(self.counts, over - 1)[over - 1])  # the largest of those beyond the capacity
            self.lost += least
            some = self.counts > least
            self.hashes, self.counts = self.hashes[some], self.counts[some] - least

    def survivors(self, threshold: int) -> np.ndarray:
        """Sorted hashes of all that may have reached the threshold."""
        self.settle()
        return self.hashes[self.counts + self.lost >= threshold]


# ---------------------------------------------------------------- packed lists of 48-bit hashes
def pack(h: np.ndarray) -> bytes:
    """Sorted distinct hashes as gaps of four bytes, the few larger ones in eight after them."""
    gaps = np.diff(h, prepend=np.uint64(0))
    top = np.uint64((1 << 32) - 1)
    far = gaps >= top
    return len(h).to_bytes(4, "little") + np.where(far, top, gaps).astype("<u4").tobytes() + gaps[far].astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    gaps = np.frombuffer(data, "<u4", n, 4).astype(np.uint64)
    far = gaps == np.uint64((1 << 32) - 1)
    if far.any():
        gaps[far] = np.frombuffer(data, "<u8", int(far.sum()), 4 + 4 * n)
    return np.cumsum(gaps, dtype=np.uint64)


def _cut(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where the partitions' slices of the sorted hashes begin and end."""
    bounds = np.array([(b << BITS) // n_buckets for b in range(1, n_buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(h, bounds), [len(h)])).astype(np.int64)


# ---------------------------------------------------------------- blocks
class _Language:
    """The texts of one language in a block: word numbers (0 ends a piece) and the hash of the phrase that begins at each."""

    def __init__(self, lang: str, texts: list[str | None]):
        raw = b"\n".join((t or "").encode("utf-8", "surrogatepass") for t in texts).translate(FOLD)
        numbers, self.words = W.codes(b"\n " + raw.replace(b"\n", b" \n ") + b" \n ")
        self.lang, self.ids = lang, numbers  # the first word is the piece's end, so its number is 0
        self.n_words = int((numbers > 0).sum())
        h = C.hash_words(self.words)[numbers]
        self.hashes, self.at = [], []
        at, now = np.flatnonzero(numbers), C.mix(h, int.from_bytes(C.hash_words([lang.encode()]).tobytes(), "little"))
        for k in range(MOST_WORDS):
            if k:
                at = at[numbers[at + k] > 0]  # the last number of all is 0
                now = C.mix(now[at], h[at + k])
            else:
                now = now[at]
            self.at.append(at)
            self.hashes.append(now >> np.uint64(64 - BITS))
            full = np.zeros(len(numbers), np.uint64)
            full[at] = now
            now = full

    def counted(self, k: int, some: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(phrase, count) of the phrases of k + 1 words that begin at self.at[k][some]."""
        at = self.at[k][some]
        codes = [self.ids[at + j].astype(np.int64) for j in range(k + 1)]
        order = np.lexsort(codes[::-1])
        codes = [c[order] for c in codes]
        new = np.zeros(len(at), bool)
        new[:1] = True
        for c in codes:
            new[1:] |= c[1:] != c[:-1]
        heads = np.flatnonzero(new)
        texts = pa.array(self.words, pa.binary())
        parts = [texts.take(pa.array(c[heads])) for c in codes]
        phrase = parts[0] if not k else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
        return phrase.cast(pa.string()), np.diff(np.append(heads, len(at)))


def _languages(table: pa.Table) -> list[_Language]:
    by: dict[str, list] = {}
    for lang, text in zip(table.column("lang").to_pylist(), table.column("text").to_pylist()):
        by.setdefault(lang, []).append(text)
    return [_Language(k, by[k]) for k in sorted(by)]


def _distinct(languages: list[_Language]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([h for x in languages for h in x.hashes])
    every.sort()
    heads = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
    return every[heads], np.diff(np.append(heads, len(every)))


def _send(n_buckets: int):
    def send(key, table):
        h, c = _distinct(_languages(table))
        at = _cut(h, n_buckets)
        some = np.flatnonzero(at[1:] > at[:-1])
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "block": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "data": pa.array([pack(h[at[k] : at[k + 1]]) for k in some], pa.binary()),
            "counts": pa.array([C.pack_counts(c[at[k] : at[k + 1]]) for k in some], pa.binary()),
        })

    return send


def _survive(threshold: int):
    """Merges the lists of a partition of the hash space and answers each block with a bit for each of its phrases."""

    def survive(key, table):
        lists = list(zip(table.column("block").to_pylist(), table.column("data").to_pylist(), table.column("counts").to_pylist()))
        mass = sum(int(C.unpack_counts(c, int.from_bytes(d[:4], "little")).sum()) for _, d, c in lists)
        summary = Summary(mass // threshold + 1)
        for _, d, c in lists:
            h = unpack(d)
            summary.add(h, C.unpack_counts(c, len(h)))
        alive, blocks, bits = summary.survivors(threshold), [], []
        for block, d, _ in lists:
            held = np.isin(unpack(d), alive, assume_unique=True, kind="sort")
            if held.any():
                blocks.append(block)
                bits.append(np.packbits(held).tobytes())
        return pa.table({"block": pa.array(blocks, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(blocks), pa.int32()), "alive": pa.array(bits, pa.binary())})

    return survive


def _members(h: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Which of h are in the sorted alive: a table of low bits rules out most."""
    if not len(alive):
        return np.empty(0, np.int64)
    low = np.uint64((1 << 22) - 1)
    maybe = np.zeros(1 << 22, bool)
    maybe[alive & low] = True
    some = np.flatnonzero(maybe[h & low])
    at = np.minimum(np.searchsorted(alive, h[some]), len(alive) - 1)
    return some[alive[at] == h[some]]


def _count(n_buckets: int):
    """The block's surviving phrases with their counts, and each language's words (size 0)."""

    def count(key, left, right):
        languages = _languages(left)
        h, _ = _distinct(languages) if languages else (np.empty(0, np.uint64), None)
        at = _cut(h, n_buckets)
        held = np.zeros(len(h), bool)
        for k, bits in zip(right.column("bucket").to_pylist(), right.column("alive").to_pylist()):
            held[at[k] : at[k + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=at[k + 1] - at[k])
        alive, parts = h[held], []
        for x in languages:
            rows = [(0, pa.array([""]), np.array([x.n_words]))]
            rows += [(k + 1, *x.counted(k, _members(g, alive))) for k, g in enumerate(x.hashes)]
            parts += [(x.lang, size, phrase, n) for size, phrase, n in rows if len(n)]
        names = [p[0] for p in parts]
        lengths = [len(p[3]) for p in parts]
        return pa.table({
            "lang": pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(parts)), lengths), pa.int64())),
            "phrase": pa.chunked_array([p[2] for p in parts], pa.string()),
            "size": pa.array(np.repeat([p[1] for p in parts], lengths).astype(np.int32)),
            "n": pa.array(np.concatenate([p[3] for p in parts]).astype(np.int64) if parts else np.empty(0, np.int64)),
        })

    return count


# ---------------------------------------------------------------- tables
def counts(docs: DataFrame, threshold: int = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs(text, lang) -> lang, phrase, size, n: exact counts of all phrases that reach the threshold, and of all words (size 0)."""
    spark = docs.sparkSession
    n_blocks, n_buckets = C.block_counts(docs, block_bytes)
    key = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(n_blocks)).cast("int")
    blocks = docs.select(key.alias("block"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    sent = blocks.groupBy("block").applyInArrow(_send(n_buckets), SENT)
    alive = C.materialize(sent.groupBy("bucket").applyInArrow(_survive(threshold), ALIVE))
    del sent
    C.release(spark)
    found = blocks.groupBy("block").cogroup(alive.groupBy("block")).applyInArrow(_count(n_buckets), COUNTED)
    summed = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where((F.col("n") >= threshold) | (F.col("size") == 0))
    out = C.materialize(summed)
    C.release(spark)
    return out


def scored(counted: DataFrame) -> DataFrame:
    """Exact counts -> candidates with a, l, r and score at their lowest cut, those inside longer ones dropped."""
    parts = counted.where(f"size between 1 and {MOST_WORDS - 1}").select("lang", "phrase", "n")
    candidates = counted.where("size > 1").withColumnRenamed("n", "a")
    ws = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(ws, F.lit(1), F.col("cut")), " ")).withColumn("right", F.array_join(F.slice(ws, F.col("cut") + 1, F.col("size")), " "))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", (a * a).cast("decimal(32,0)") * F.lit(SCALE).cast("decimal(7,0)"), l * r)
    told = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    best = told.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("size").alias("size"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    within = candidates.where("size > 2").select("lang", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda i: F.array_join(F.slice(ws, i, F.lit(2)), " "))).alias("phrase"), "a")
    longer = within.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("most").isNull() | (COVER[1] * F.col("most") < COVER[0] * F.col("a")))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def ranked(rows: DataFrame, first: int = FIRST, share_rows: int = SHARE_ROWS) -> DataFrame:
    """The first rows of each language by score, a and phrase, with their rank."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = max(16, -(-rows.count() // share_rows))
    drawn = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    drawn = drawn.withColumn("k", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("k") <= first)
    return drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first).drop("k", "share")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, first: int = FIRST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text, lang) -> lang, rank, phrase, a, l, r, n, score."""
    counted = counts(docs, threshold, block_bytes)
    rows = ranked(C.materialize(scored(counted)), first)
    totals = counted.where("size = 0").select("lang", F.col("n").alias("n"))
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql() -> str:
    """The same by counting every phrase."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""with pieces as (select coalesce(lang, '{UNKNOWN}') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
  w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces),
  total as (select lang, sum(len(ws)) as n from w group by lang),
  grams as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (select unnest([1, 2, 3]) as k) where len(ws) >= k)),
  f as (select lang, k, phrase, count(*)::hugeint as a from grams group by all having count(*) >= {THRESHOLD}),
  cuts as (select lang, k, phrase, a, c, array_to_string(string_split(phrase, ' ')[:c], ' ') as x, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') as y from (select *, unnest(range(1, k)) as c from f where k > 1)),
  told as (select u.*, p.a as l, q.a as r, ({SCALE}::hugeint * u.a * u.a) // (p.a * q.a) as score from cuts u join f p on p.lang = u.lang and p.phrase = u.x join f q on q.lang = u.lang and q.phrase = u.y),
  best as (select * from told qualify row_number() over (partition by lang, phrase order by score, c) = 1),
  kept as (select * from best b where not exists (select 1 from f t where t.k = 3 and b.k = 2 and t.lang = b.lang and {COVER[1]} * t.a >= {COVER[0]} * b.a
    and (array_to_string(string_split(t.phrase, ' ')[:2], ' ') = b.phrase or array_to_string(string_split(t.phrase, ' ')[2:], ' ') = b.phrase))),
  r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
  select r.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, total.n::bigint as n, score::bigint as score from r join total on total.lang = r.lang where rank <= {FIRST}"""
