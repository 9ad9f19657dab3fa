"""Comparing the members of groups with one another, spread over tasks.

A group is dealt into tiles of at most about `tile` members by a hash of the member; one
comparison is that of a pair of tiles, so that its size is bounded and a large group is
shared out.  Comparisons are packed into slots: a task takes the rows of many small groups
or of a few tile pairs at once.  Tasks give counts of links and a spanning forest of what they
linked (at most one row for a member), never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tiles(size: Column, tile: int) -> Column:
    """Into how many tiles a group of this size is dealt; a member is in as many comparisons."""
    return F.greatest(F.ceil(size / tile), F.lit(1)).cast("int")


def deal(members: DataFrame, tile: int, slots: int, group: tuple[str, ...], member: str = "uid", size: str = "size") -> DataFrame:
    """members with mine (own tile), ga and gb (the tiles compared) and slot: a row for each comparison a member is in."""
    dealt = members.withColumn("_n", tiles(F.col(size), tile))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64(member, F.lit(11)), F.col("_n").cast("long")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    dealt = dealt.withColumn("ga", F.least("mine", "_o")).withColumn("gb", F.greatest("mine", "_o")).drop("_n", "_o")
    return dealt.withColumn("slot", F.pmod(F.xxhash64(*group, "ga", "gb", F.lit(5)), F.lit(slots).cast("long")).cast("int"))


class Comparisons:
    """The comparisons of a slot: rows in the order of (group, ga, gb), tile ga before tile gb.

    order sorts the slot's rows; after that segment k is rows starts[k]:middle[k] against
    middle[k]:ends[k], or against one another where same[k] holds (a tile with itself).
    """

    def __init__(self, group: list[np.ndarray], ga: np.ndarray, gb: np.ndarray, mine: np.ndarray, member: np.ndarray):
        self.order = np.lexsort((member, mine == gb, gb, ga, *group))
        keys = [k[self.order] for k in (*group, ga, gb)]
        head = np.ones(len(ga), bool)
        for k in keys:
            head[1:] &= k[1:] == k[:-1]
        head[1:] = ~head[1:]
        self.starts = np.flatnonzero(head)
        self.ends = np.append(self.starts[1:], len(ga))
        same = keys[-1] == keys[-2]
        self.same = same[self.starts]
        second = np.append(0, np.cumsum((mine[self.order] == keys[-1]) & ~same))
        self.middle = self.ends - (second[self.ends] - second[self.starts])

    def pairs(self, of: np.ndarray, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of rows of the segments `of`, some `chunk` at a time."""
        length = (self.ends - self.starts)[of]
        total = int(length.sum())
        row = np.arange(total) - np.repeat(np.cumsum(length) - length, length) + np.repeat(self.starts[of], length)
        end, middle, whole = (np.repeat(x[of], length) for x in (self.ends, self.middle, self.same))
        first = np.where(whole, row + 1, middle)
        n = np.where(whole, end - row - 1, np.where(row < middle, end - middle, 0))
        upto = np.cumsum(n)
        at = 0
        while at < total:
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + chunk, "right")))
            k = n[at:to]
            a = np.repeat(row[at:to], k)
            if len(a):
                yield a, np.arange(len(a)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[at:to], k)
            at = to


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of each of n members under the links (a, b): the smallest index reachable."""
    root = np.arange(n)
    if not len(a):
        return root
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
