"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

A vector is padded to a power of two and rotated by three rounds of random signs and a fast
Walsh-Hadamard transform; its hash is the coordinate largest in size, with its sign.  A table
joins a few such hashes in a bucket.  Multiprobe: a vector enters, besides its own bucket,
the buckets that the next largest coordinates would give, best first.  Vectors of one label
that meet in a bucket are candidates; within a bucket tiles are compared by exact cosine in
double precision.  A pair counts in the first bucket that both are in, so a link counts once.

How many hashes a table joins follows from the counted vectors of the largest label, so that
a bucket's expected size does not grow with the data; how many tables there are follows from
the recall asked for, measured on random pairs of exactly the cosine asked for (plan()).

Equal vectors (bit for bit, same label) are a class, compared once.  Hot labels and buckets
are dealt to tiles (pairs.py).

Defined cases: a null label or vector, a zero vector, or one with a null or non-finite
component links with nothing and is a component of its own; vectors of other lengths than
the one they meet do not link with it; rows with a null vec_id are left out; repeated rows
are rows, and unlike vectors under one vec_id are vectors of their own; a very long vector is
taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C
from colloquy.llm import pairs

COSINE = 0.93
PROBES = 3
RECALL = 0.999  # of pairs at exactly the cosine asked for
MOST_HASHES = 4
MOST_TABLES = 255  # a byte of the bucket's number
BATCH_BYTES = 32 << 20  # of vectors and codes in a batch that a task yields
TILE = 512
SMALL = 32  # members of a bucket from which on it is compared as a matrix
SLOT_ROWS = 2_000  # vectors in a task's comparison
CHUNK = 1 << 14  # pairs compared at once
SLACK = 1e-12  # a cosine that rounding puts below the threshold is recomputed by long doubles
LINKS = "uid long, root long, links long"


def _signs(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(7 + dim).choice([-1.0, 1.0], (count, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two)."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray, tables: int, hashes: int, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers [vector, table, probe] of unit vectors: own first, then by falling score."""
    n, d = x.shape
    dim = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, dim))
    padded[:, :d] = x
    out = np.empty((n, tables, probes), np.int64)
    signs = _signs(dim, hashes * tables)
    best = min(3, dim)
    for t in range(tables):
        cost, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for k in range(hashes):
            y = padded
            for r in range(3):
                y = hadamard(y * signs[hashes * t + k, r])
            top = np.argsort(-np.abs(y), 1, kind="stable")[:, :best]
            value = np.take_along_axis(y, top, 1)
            size = np.abs(value)
            # a coordinate costs what it falls short of the largest one
            cost = (cost[:, :, None] + ((size[:, :1] - size) ** 2)[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * dim) + (top * 2 + (value < 0))[:, None, :]).reshape(n, -1)
            order = np.argsort(cost, 1, kind="stable")[:, :probes]
            cost, code = np.take_along_axis(cost, order, 1), np.take_along_axis(code, order, 1)
        out[:, t, : code.shape[1]] = code
        out[:, t, code.shape[1] :] = code[:, :1]
    return out


@lru_cache(maxsize=64)
def tables_for(dim: int, hashes: int, cosine: float, recall: float = RECALL, probes: int = PROBES) -> int:
    """How many tables bring a pair of this cosine together often enough, measured on 2 000 random pairs."""
    rnd = np.random.default_rng(dim * 8 + hashes)
    a = rnd.normal(size=(2000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rnd.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + np.sqrt(max(0.0, 1 - cosine**2)) * b
    p, q = buckets(a, 2, hashes, probes), buckets(b, 2, hashes, probes)
    met = (p[:, :, :, None] == q[:, :, None, :]).any((2, 3)).mean()
    return int(np.ceil(np.log(1 - recall) / np.log1p(-min(max(met, 0.01), 0.999))))


def plan(count: int, dim: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(hashes, tables) for so many vectors of a label: buckets of a table at least a quarter of the vectors.

    A code of hashes must fit 40 bits, and MOST_TABLES tables are the most: a low cosine takes fewer hashes, and if even
    one needs more tables, none (all vectors of a label are compared in tiles).
    """
    hashes, wide = 2, 2 << max(1, (dim - 1).bit_length())
    while hashes and (wide**hashes >= 1 << 40 or tables_for(dim, hashes, cosine, recall) > MOST_TABLES):
        hashes -= 1
    while 1 < hashes < MOST_HASHES and wide**hashes * 4 < count and wide ** (hashes + 1) < 1 << 40 and tables_for(dim, hashes + 1, cosine, recall) <= MOST_TABLES:
        hashes += 1
    return hashes, tables_for(dim, hashes, cosine, recall) if hashes else 1


def _vectors(column) -> list:
    """A double vector for each usable row, None for others."""
    out = []
    for v in column.to_pylist():
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float64)
        if x is not None and (not len(x) or not np.isfinite(x).all() or not x.any()):
            x = None
        out.append(x)
    return out


def _usable(kind):
    """The vectors' bytes, null where a vector links with nothing."""

    def run(batches):
        for batch in batches:
            packed = [None if v is None else (v + 0.0).astype(kind).tobytes() for v in _vectors(batch.column("embedding"))]  # -0.0 is 0.0
            usable = [None if l is None else p for p, l in zip(packed, batch.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(usable, pa.binary())], ["vec_id", "label", "vector"])

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # keeps tiny and huge vectors finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _in_buckets(kind, plans: dict[int, tuple[int, int]]):
    """Each vector in its buckets; codes are its bucket numbers, table by table."""

    def run(batches):
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            data = batch.column("vector").to_pylist()
            for i, v in enumerate(data):
                by_dim.setdefault(len(v) // kind().itemsize, []).append(i)
            per_row = {dim: (8 * dim + 8 * PROBES * plans[dim][1]) * PROBES * plans[dim][1] for dim in by_dim}
            for dim, at in ((d, a[k : k + max(1, BATCH_BYTES // per_row[d])]) for d, a in by_dim.items() for k in range(0, len(a), max(1, BATCH_BYTES // per_row[d]))):
                hashes, tables = plans[dim]
                x = _unit(np.stack([np.frombuffer(data[i], kind) for i in at]).astype(np.float64))
                own = buckets(x, tables, hashes)
                flat = np.sort((own + (np.arange(tables)[:, None] << 40) + (dim % (1 << 15) << 48)).reshape(len(at), -1), 1)
                fresh = np.ones(flat.shape, bool)
                fresh[:, 1:] = flat[:, 1:] != flat[:, :-1]
                row = np.repeat(np.arange(len(at)), fresh.sum(1))
                narrow = np.int32 if own.max() < 2**31 else np.int64
                codes = pa.array([x.tobytes() for x in own.astype(narrow)], pa.binary()).take(pa.array(row))
                take = pa.array(np.array(at)[row])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(take) for c in ("uid", "label", "n_vecs", "vector")), pa.array(flat[fresh]), codes],
                    ["uid", "label", "n_vecs", "vector", "bucket", "codes"])

    return run


def _first_met(p: np.ndarray, q: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Is this bucket the first that both are in?  p, q: [pair, table, probe]."""
    met = (p[:, :, :, None] == q[:, :, None, :]).any(3)
    t, n = met.any(2).argmax(1), np.arange(len(p))
    least = np.where(met[n, t], p[n, t], np.iinfo(np.int64).max).min(1)
    return (t == bucket >> 40 & 255) & (least == bucket & (1 << 40) - 1)


def _verify(cosine: float, kind, n_tables: dict[int, int]):
    def verify(key, table):
        uid, bucket, mine, ga, gb, n_vecs = (table.column(c).to_numpy().astype(np.int64) for c in ("uid", "bucket", "mine", "ga", "gb", "n_vecs"))
        label = np.unique(np.array(table.column("label").to_pylist(), object).astype(str), return_inverse=True)[1]
        c = pairs.Comparisons([bucket, label], ga, gb, mine, uid)
        uid, bucket, n_vecs = uid[c.order], bucket[c.order], n_vecs[c.order]
        vectors, codes = table.column("vector").to_pylist(), table.column("codes").to_pylist()
        dims, place = np.array([len(v) // kind().itemsize for v in vectors])[c.order], np.empty(len(uid), np.int64)
        x, of_code = {}, {}
        for dim in np.unique(dims):  # a bucket holds one length only
            at = np.flatnonzero(dims == dim)
            place[at] = np.arange(len(at))
            x[dim] = _unit(np.stack([np.frombuffer(vectors[i], kind) for i in c.order[at]]).astype(np.float64))
            of_code[dim] = [codes[i] for i in c.order[at]]

        def code(dim, rows):
            of = [of_code[dim][k] for k in rows]
            wide = [np.frombuffer(d, np.int32 if len(d) == 4 * PROBES * n_tables[dim] else np.int64) for d in of]
            return np.stack(wide).astype(np.int64).reshape(-1, n_tables[dim], PROBES)

        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

        def keep(dim, a, b):
            """Of candidate rows those that are links and first met here."""
            if not len(a):
                return
            p, q = x[dim][place[a]], x[dim][place[b]]
            near = (p.astype(np.longdouble) * q).sum(1).astype(np.float64) >= cosine
            a, b = a[near], b[near]
            if len(a):
                first = _first_met(code(dim, place[a]), code(dim, place[b]), bucket[a])
                left.append(a[first])
                right.append(b[first])

        length, dim_of = c.ends - c.starts, dims[c.starts]
        for dim in x:
            for a, b in c.pairs(np.flatnonzero((length < SMALL) & (dim_of == dim)), CHUNK):
                near = np.einsum("ij,ij->i", x[dim][place[a]], x[dim][place[b]]) >= cosine - SLACK
                keep(dim, a[near], b[near])
        for k in np.flatnonzero(length >= SMALL):
            s, m, e, dim = c.starts[k], c.middle[k], c.ends[k], dim_of[k]
            i, j = (np.arange(s, e), np.arange(s, e)) if c.same[k] else (np.arange(s, m), np.arange(m, e))
            near = x[dim][place[i]] @ x[dim][place[j]].T >= cosine - SLACK
            a, b = np.nonzero(np.triu(near, 1) if c.same[k] else near)
            for at in range(0, len(a), CHUNK):
                keep(dim, i[a[at : at + CHUNK]], j[b[at : at + CHUNK]])
        a, b = np.concatenate(left), np.concatenate(right)
        names, of = np.unique(uid, return_inverse=True)
        links = np.bincount(of[a], n_vecs[b], len(names)) + np.bincount(of[b], n_vecs[a], len(names))
        root, some = names[pairs.forest(len(names), of[a], of[b])], links > 0
        return pa.table({"uid": names[some], "root": root[some], "links": links[some].astype(np.int64)})

    return verify


def dedup(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """vectors(vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    kind, of_numpy = ("float", np.float32) if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else ("double", np.float64)
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>"), F.col("label").cast("string"))
    named = rows.mapInArrow(_usable(of_numpy), "vec_id long, label string, vector binary").withColumn("name", F.md5("vector"))
    same = C.materialize(
        named.where("vector is not null").groupBy("label", "name").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n_vecs"), F.first("vector").alias("vector"))
        .withColumn("uid", F.monotonically_increasing_id()))
    dim = (F.octet_length("vector") / of_numpy().itemsize).cast("int")
    most = same.groupBy("label", dim.alias("dim")).agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()  # a row for each length of vectors
    plans = {r.dim: plan(r.n, r.dim, cosine, recall) for r in most}
    placed = same.select("uid", "label", "n_vecs", "vector").mapInArrow(_in_buckets(of_numpy, plans), "uid long, label string, n_vecs long, vector binary, bucket long, codes binary")
    sizes = C.materialize(placed.groupBy("label", "bucket").agg(F.count("*").alias("size")).where("size > 1"))
    n = sizes.agg(F.sum(F.col("size") * pairs.tiles(F.col("size"), tile))).first()[0] or 0
    dealt = pairs.deal(placed.join(sizes, ["label", "bucket"]), tile, -(-n // SLOT_ROWS) or 1, ("label", "bucket"))
    found = C.materialize(
        dealt.select("slot", "label", "bucket", "ga", "gb", "mine", "uid", "n_vecs", "vector", "codes")
        .groupBy("slot").applyInArrow(_verify(cosine, of_numpy, {d: t for d, (_, t) in plans.items()}), LINKS)
    )
    C.release(vectors.sparkSession)
    comps = C.materialize(C.connected_components(found.select(F.col("uid").alias("a"), F.col("root").alias("b"))).select(F.col("id").alias("uid"), F.col("component").alias("class")))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    least = comps.join(same.select("uid", "rep"), "uid").groupBy("class").agg(F.min("rep").alias("component"))
    by_class = same.select("uid", "label", "name", "rep", "n_vecs").join(links, "uid", "left").join(C.join_spread(comps, least, "class", "uid"), "uid", "left")
    out = named.drop("vector").join(by_class, ["label", "name"], "left")
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("n_vecs") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (component == F.col("vec_id")).alias("kept"),
    )
