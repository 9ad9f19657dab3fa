"""Vector code compression: product codes from integer codebooks, learned by dual-tree Lloyd rounds.

Components become integers floor(1024*x); a vector is four parts, each coded by the nearest of
256 entries of its part position's codebook.  Vectors lie in blocks, written once; a block has a
tree over the parts of each position: parts in tree order, every node a range of them with its
box, and running sums from which a node's sum is one subtraction.  In every round a tree over
the entries is met with each tree over parts, level by level:

- the boxes of a pair of nodes bound the distances of all its parts and entries; a pair goes
  when its least distance is above the largest that another pair of the same parts can have;
- parts whose node is left with one entry are assigned as a whole, by the node's sum;
- leaves that keep several entries are assigned by integer distances to these, ties to the
  lower index.

Tasks return sums and counts by entry (at most 4*256 times a part's length), which Spark adds.
All numbers are integers: exact doubles while squares stay below 2^53, else Python's integers.

Hot keys: vectors are dealt to blocks without a key; equal labels are summed before the shuffle,
and the sums join back over salts.  Entries and sums are bounded by the codebooks' size.

Defined cases: rows whose vector is null, empty, or has a null or non-finite component are left
out, as are components of 2^51 and more in size, and vectors of another length than that of the
smallest vec_id; a length that four does not divide is filled up with zeros; fewer than 256
vectors are as many entries; a null vec_id is coded and is the last to be an entry; repeated
vec_ids are vectors of their own, ordered by their components; an error beyond a long is null,
and so is the sum over a label that has one; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C
from colloquy.llm.words import ranges

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LEAF = 32  # parts of a tree's leaf at most
BLOCK_BYTES = 4 << 20
LARGEST = float(1 << 51)
LONGEST = (1 << 63) - 1
SUMS = "part int, entry int, pos int, s decimal(38,0)"


# ---------------------------------------------------------------- trees
def nodes(n: int, leaf: int) -> list[np.ndarray]:
    """Borders of the nodes of each level of a tree over n rows: level k has 2^k ranges, each halved below."""
    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max() > leaf:
        b = levels[-1]
        out = np.empty(2 * len(b) - 1, np.int64)
        out[::2], out[1::2] = b, (b[:-1] + b[1:]) // 2
        levels.append(out)
    return levels


def tree_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """The order in which every node's rows are the lower or upper half of its parent's, in its widest direction."""
    order = np.arange(len(x))
    for b in nodes(len(x), leaf)[:-1]:
        for s, e in zip(b, b[1:]):
            mine = x[order[s:e]]
            if e - s > 1:
                wide = (mine.max(0) - mine.min(0)).argmax()
                order[s:e] = order[s:e][np.argsort(mine[:, wide], kind="stable")]
    return order


class Tree:
    """Rows in tree order with the boxes of every level's nodes and running sums."""

    def __init__(self, x: np.ndarray, leaf: int):
        self.x, self.levels = x, nodes(len(x), leaf)
        low, high = [], []
        for b in self.levels[::-1]:
            if not low:
                low.append(np.minimum.reduceat(x, b[:-1]))
                high.append(np.maximum.reduceat(x, b[:-1]))
            else:
                low.append(np.minimum(low[-1][::2], low[-1][1::2]))
                high.append(np.maximum(high[-1][::2], high[-1][1::2]))
        self.low, self.high = low[::-1], high[::-1]
        self.sums = np.zeros((len(x) + 1, x.shape[1]), x.dtype)
        np.cumsum(x, 0, out=self.sums[1:])


class Entries:
    """A codebook as a tree whose leaves are single entries; number[k] is the index of the k-th in tree order."""

    def __init__(self, entries: np.ndarray):
        self.number = tree_order(entries, 1)
        self.tree = Tree(entries[self.number], 1)


def _bounds(p: Tree, i: int, nodes_p: np.ndarray, e: Tree, j: int, nodes_e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance of the boxes of pairs of nodes."""
    pl, ph, el, eh = p.low[i][nodes_p], p.high[i][nodes_p], e.low[j][nodes_e], e.high[j][nodes_e]
    up, down = el - ph, pl - eh
    gap = np.maximum(np.maximum(up, down), 0)
    far = np.maximum(eh - pl, ph - el)
    return (gap * gap).sum(1), (far * far).sum(1)


def assign(p: Tree, entries: Entries) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(begin, end, entry) of ranges assigned as a whole, and (rows, entries, -1) of rows of uncertain leaves."""
    e = entries.tree
    a, b, i, j = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        least, most = _bounds(p, i, a, e, j, b)
        heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))  # pairs of one node of parts stand together
        lengths = np.diff(np.append(heads, len(a)))
        near = least <= np.repeat(np.minimum.reduceat(most, heads), lengths)
        a, b = a[near], b[near]
        if j == len(e.levels) - 1:
            heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            lengths = np.diff(np.append(heads, len(a)))
            sure = (lengths == 1) & (np.diff(e.levels[j])[b[heads]] == 1)
            for k in heads[sure]:
                yield p.levels[i][a[k]], p.levels[i][a[k] + 1], int(entries.number[e.levels[j][b[k]]])
            left = np.repeat(~sure, lengths)
            a, b = a[left], b[left]
        if not len(a):
            return
        if i == len(p.levels) - 1 and j == len(e.levels) - 1:
            break
        if i < len(p.levels) - 1:
            i, a, b = i + 1, np.concatenate((2 * a, 2 * a + 1)), np.concatenate((b, b))
        if j < len(e.levels) - 1:
            j, a, b = j + 1, np.concatenate((a, a)), np.concatenate((2 * b, 2 * b + 1))
        some = np.diff(p.levels[i])[a] > 0  # a small tree has empty nodes
        some &= np.diff(e.levels[j])[b] > 0
        a, b = a[some], b[some]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
    square = (e.x * e.x).sum(1)
    heads = np.append(np.flatnonzero(np.append(True, a[1:] != a[:-1])), len(a))
    for s, t in zip(heads, heads[1:]):
        begin, end = p.levels[i][a[s]], p.levels[i][a[s] + 1]
        at = ranges(e.levels[j][b[s:t]], np.diff(e.levels[j])[b[s:t]])
        at = at[np.argsort(entries.number[at])]  # the first of equal distances is the lowest index
        away = square[at] - 2 * (p.x[begin:end] @ e.x[at].T)
        yield np.arange(begin, end), entries.number[at][away.argmin(1)], -1


# ---------------------------------------------------------------- tasks
def _integers(batches):
    """vec_id, label and the integers of usable vectors, eight bytes each."""
    for batch in batches:
        column = batch.column("embedding")
        values = column.flatten()  # of rows that are not null
        off = np.zeros(len(column) + 1, np.int64)
        off[1:] = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        x = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components are NaN
        wrong = np.append(0, np.cumsum(~(np.abs(x) < LARGEST)))
        keep = np.flatnonzero((off[1:] > off[:-1]) & (wrong[off[1:]] == wrong[off[:-1]]))
        whole = np.floor(np.where(np.abs(x) < LARGEST, x, 0) * SCALE).astype("<i8")
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(keep)), batch.column("label").take(pa.array(keep)), pa.array([whole[off[k] : off[k + 1]].tobytes() for k in keep], pa.binary())],
            ["vec_id", "label", "ints"])


def _matrix(data: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(data), -(-dim // PARTS) * PARTS), np.int64)
    out[:, :dim] = np.frombuffer(b"".join(data), "<i8").reshape(len(data), dim)
    return out


def _blocks(dim: int, rows: int):
    """Rows of vectors -> blocks: the order of each part position's tree, and the parts in it."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        x, orders, parts = _matrix(t.column("ints").to_pylist(), dim), [], []
        for part in np.split(x, PARTS, 1):
            order = tree_order(part, LEAF)
            orders.append(order.astype("<i4").tobytes())
            parts.append(part[order].astype("<i8").tobytes())
        whole = lambda c: pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(c).combine_chunks() if t.column(c).num_chunks != 1 else t.column(c).chunk(0))
        return pa.RecordBatch.from_arrays([whole("vec_id"), whole("label"), pa.array([orders], pa.list_(pa.binary())), pa.array([parts], pa.list_(pa.binary()))], ["ids", "labels", "orders", "parts"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, rows - n)
                held.append(take)
                n += take.num_rows
                batch = batch.slice(take.num_rows)
                if n == rows:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return run


def _number(x: np.ndarray, exact: bool) -> np.ndarray:
    return x.astype(np.float64) if exact else x.astype(object)


def _sum_up(books: np.ndarray, exact: bool):
    """Blocks -> the sums and counts (pos -1) of each entry over the task's blocks."""
    n_entries, d = books.shape[1:]

    def run(batches):
        total = np.zeros((PARTS, n_entries, d + 1), object)
        seen = False
        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                seen = True
                for k, data in enumerate(parts):
                    p = Tree(_number(np.frombuffer(data, "<i8").reshape(-1, d), exact), LEAF)
                    sums, counts = np.zeros((n_entries, d), p.x.dtype), np.zeros(n_entries, np.int64)
                    for a, b, entry in assign(p, Entries(_number(books[k], exact))):
                        if entry < 0:
                            np.add.at(sums, b, p.x[a])
                            counts += np.bincount(b, minlength=n_entries)
                        else:
                            sums[entry] += p.sums[b] - p.sums[a]
                            counts[entry] += b - a
                    total[k, :, :d] += sums.astype(np.int64).astype(object) if exact else sums
                    total[k, :, d] += counts
        if seen:
            part, entry = np.nonzero(total[:, :, d])
            k = len(part)
            pos = np.tile(np.append(np.arange(d), -1), k)
            s = pa.array([Decimal(v) for v in total[part, entry].ravel()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part, d + 1), pa.int32()), pa.array(np.repeat(entry, d + 1), pa.int32()), pa.array(pos, pa.int32()), s], ["part", "entry", "pos", "s"])

    return run


def _encode(books: np.ndarray, exact: bool):
    """Blocks -> vec_id, label, code, error."""
    d = books.shape[2]

    def run(batches):
        for batch in batches:
            for ids, labels, orders, parts in zip(*(batch.column(c) for c in ("ids", "labels", "orders", "parts"))):
                n = len(ids)
                codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64 if exact else object)
                for k, (order, data) in enumerate(zip(orders.as_py(), parts.as_py())):
                    p = Tree(_number(np.frombuffer(data, "<i8").reshape(-1, d), exact), LEAF)
                    book, got = _number(books[k], exact), np.empty(n, np.int64)
                    for a, b, entry in assign(p, Entries(book)):
                        if entry < 0:
                            got[a] = b
                        else:
                            got[a:b] = entry
                    away = p.x - book[got]
                    order = np.frombuffer(order, "<i4")
                    codes[order, k] = got
                    error[order] += (away * away).sum(1).astype(error.dtype)
                told = codes.tobytes().hex()
                w = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([told[i : i + w] for i in range(0, w * n, w)], pa.string()), pa.array([v if v <= LONGEST else None for v in error.tolist()], pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return run


# ---------------------------------------------------------------- tables
def learn(blocks: DataFrame, books: np.ndarray, exact: bool, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd rounds from books[part, entry, position]; entries that nothing is assigned to stay."""
    for _ in range(rounds):
        told = blocks.select("parts").mapInArrow(_sum_up(books, exact), SUMS).groupBy("part", "entry", "pos").agg(F.sum("s").alias("s")).collect()  # at most the books' size
        sums, counts = books.astype(object), np.ones(books.shape[:2], object)
        for r in told:
            if r.pos < 0:
                counts[r.part, r.entry] = int(r.s)
            else:
                sums[r.part, r.entry, r.pos] = int(r.s)
        books = (sums // counts[:, :, None]).astype(np.int64)
    return books


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """vectors(vec_id, embedding, label) -> vec_id, code, error, label_error, codebooks_sha256."""
    spark = vectors.sparkSession
    label = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    kept = C.materialize(rows.mapInArrow(_integers, f"vec_id long, label {label}, ints binary"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "ints").select("ints").first()
    if first is None:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    dim = len(first.ints) // 8
    kept = kept.where(F.octet_length("ints") == 8 * dim)
    begin = kept.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").collect()  # the entries
    books = np.stack(np.split(_matrix([r.ints for r in begin], dim), PARTS, 1))
    per_block = max(LEAF, block_bytes // (8 * dim))
    n = -(-kept.count() // per_block)
    blocks = C.materialize(
        kept.repartition(n).mapInArrow(_blocks(dim, per_block), f"ids array<bigint>, labels array<{label}>, orders array<binary>, parts array<binary>"))
    C.release(spark)
    size = blocks.select("parts").mapInArrow(_largest, "n long").agg(F.max("n")).first()[0]
    exact = books.shape[2] * (2 * size) ** 2 < 1 << 53 and per_block * size < 1 << 53
    books = learn(blocks, books, exact, rounds)
    coded = C.materialize(blocks.mapInArrow(_encode(books, exact), f"vec_id long, label {label}, code string, error long"))
    keyed = coded.withColumn("_key", F.concat(F.when(F.col("label").isNull(), "null").otherwise("="), F.coalesce(F.col("label").cast("string"), F.lit(""))))
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = keyed.groupBy("_key").agg(whole.alias("_sum")).select("_key", F.col("_sum").try_cast("long").alias("label_error"))
    text = ",".join(map(str, books.ravel().tolist()))
    told = C.join_spread(keyed, sums, "_key", "vec_id")
    return told.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def _largest(batches):
    for batch in batches:
        for parts in batch.column("parts").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([max(int(np.abs(np.frombuffer(d, "<i8")).max()) for d in parts)], pa.int64())], ["n"])


def sql() -> str:
    """The same by comparing every part with every entry, the rounds written out."""
    def assigned(books: str) -> str:
        return f"""(select vec_id, p, arg_min(e, struct_pack(d := d, e := e)) as e, min(d) as d from (select x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
      from parts x join {books} b using (p)) group by vec_id, p)"""

    parts = [f"""with kept as (select vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::double)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0),
  parts as materialized (select vec_id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] as v from kept, (select unnest(range({PARTS})) as p)),
  b0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 as e, v from parts qualify e < {ENTRIES})"""]
    for k in range(ROUNDS):
        parts.append(f"""b{k + 1} as materialized (select b.p, b.e, coalesce(m.v, b.v) as v from b{k} b left join (
    select p, e, list(floor_mean order by i) as v from (select a.p, a.e, i, (sum(x.v[i]) - ((sum(x.v[i]) % count(*)) + count(*)) % count(*)) // count(*) as floor_mean
      from {assigned(f'b{k}')} a join parts x using (vec_id, p), (select unnest(range(1, (select max(len(v)) from parts) + 1)) as i) group by all) group by p, e) m using (p, e))""")
    parts.append(f"""coded as materialized (select vec_id, string_agg(format('{{:02x}}', e), '' order by p) as code, sum(d)::bigint as error from {assigned(f'b{ROUNDS}')} group by vec_id),
  told as (select vec_id, code, error, label from coded join kept using (vec_id)),
  hash as (select sha256(string_agg(array_to_string(list_transform(v, lambda c: c::bigint), ','), ',' order by p, e)) as h from b{ROUNDS})
  select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (select h from hash) as codebooks_sha256 from told""")
    return ",\n  ".join(parts)
