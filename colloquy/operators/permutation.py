"""Epoch permutations without a sort: a bijection on row numbers.

Place and number of a row follow from each other by arithmetic: n numbers are laid out row by
row in a grid whose last row may be shorter, and a Feistel network with keys from the seed and the
epoch turns columns and rows by turns: the cells of a column move by a hash of the column, those
of a row by a hash of the row, each around its own length, so that no cell beyond n is ever met.
Every epoch is another permutation of the same rows: no sort, no table and no exchange for an epoch,
and a reader that skips to a place asks which row is there.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
M1, M2, WORD = 2654435761, 1540483477, 1 << 32


def keys(seed: int, epoch: int) -> list[int]:
    """The seed grows by one with every pass."""
    return [int(hashlib.md5(f"{seed + epoch}:{k}".encode()).hexdigest()[:8], 16) for k in range(ROUNDS)]


def width(n: int) -> int:
    """Columns of the grid."""
    if n >= 1 << 60:
        raise ValueError("too many rows")
    return math.isqrt(max(n - 1, 0)) + 1


def _rounds(rows: DataFrame, name: str, n: int, seed: int, epochs: list[int], back: bool, out: str) -> DataFrame:
    """Each round is a projection of its own, so that nothing is computed twice."""
    b = width(n)
    full, rest = divmod(n, b)
    high, long = F.lit(full) + F.when(F.col("_r") < rest, 1).otherwise(0), F.when(F.col("_l") < full, b).otherwise(rest)
    now = rows.withColumn("_l", F.floor(F.col(name) / b).cast("long")).withColumn("_r", F.col(name).cast("long") % b)
    for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
        moved, by, size = ("_l", "_r", high) if k % 2 == 0 else ("_r", "_l", long)
        key = F.lit(keys(seed, epochs[0])[k])
        for e in epochs[1:]:
            key = F.when(F.col("epoch") == e, F.lit(keys(seed, e)[k])).otherwise(key)
        now = now.withColumn("_h", (F.col(by) * F.lit(M1) + key) % F.lit(WORD))  # below 2^32; no product passes 63 bits
        now = now.withColumn("_h", (F.col("_h").bitwiseXOR(F.shiftright("_h", 15)) % F.lit(WORD >> 1)) * F.lit(M2) % F.lit(WORD))
        step = F.col("_h").bitwiseXOR(F.shiftright("_h", 13))
        now = now.withColumn(moved, F.pmod(F.col(moved) + (-step if back else step), size.cast("long")))
    return now.withColumn(out, F.col("_l") * b + F.col("_r")).drop("_l", "_r", "_h")


def placed(rows: DataFrame, n: int, seed: int, epoch: int, name: str = "i", out: str = "place") -> DataFrame:
    """rows with the place in the epoch of the row of this number (0 to n-1)."""
    return _rounds(rows, name, n, seed, [epoch], False, out)


def numbered(rows: DataFrame, n: int, seed: int, epoch: int, name: str = "place", out: str = "i") -> DataFrame:
    """rows with the number of the row that stands at this place: the inverse of placed()."""
    return _rounds(rows, name, n, seed, [epoch], True, out)


def epochs(indexed: DataFrame, n: int, seed: int, passes: list[int], world: int, name: str = "i") -> DataFrame:
    """indexed rows for each pass with place, rank (place % world) and seq (its turn at the rank).  Projections, no exchange."""
    every = indexed.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in passes])))
    out = _rounds(every, name, n, seed, passes, False, "place")
    return out.withColumn("rank", F.pmod("place", F.lit(world)).cast("int")).withColumn("seq", F.floor(F.col("place") / world))


def placed_sql(table: str, n: str, seed: int, epoch: int) -> str:
    """DuckDB text: the rows of a table with its column i, and place; n is text of a scalar count."""
    out = f"(select *, i // _b as _l, i % _b as _r, _n // _b as _full, _n % _b as _rest from (select *, cast(floor(sqrt(_n - 1)) as bigint) + 1 as _b from (select *, {n} as _n from {table})))"
    for k, key in enumerate(keys(seed, epoch)):
        moved, by, size = ("_l", "_r", "_full + case when _r < _rest then 1 else 0 end") if k % 2 == 0 else ("_r", "_l", "case when _l < _full then _b else _rest end")
        out = f"(select *, ({by} * {M1} + {key}) % {WORD} as _t from {out})"
        out = f"(select *, (xor(_t, _t >> 15) % {WORD >> 1}) * {M2} % {WORD} as _u from {out})"
        out = f"(select * exclude (_t, _u) replace (({moved} + xor(_u, _u >> 13)) % ({size}) as {moved}) from {out})"
    return f"(select * exclude (_l, _r, _b, _n, _full, _rest), _l * _b + _r as place from {out})"
