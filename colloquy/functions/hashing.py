"""Choices that depend on a key alone: the first 32 bits of its md5, modulo what is chosen from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def stable_hash(key) -> Column:
    return F.conv(F.substring(F.md5(_column(key)), 1, 8), 16, 10).cast("long")


def stable_index(key, n: int | Column) -> Column:
    if isinstance(n, int) and n <= 0:
        raise ValueError("n must be positive")
    return stable_hash(key) % n


def stable_chance(key, p: float) -> Column:
    return stable_index(key, 1000) < round(p * 1000)


def pick(key, values: tuple[str, ...]) -> Column:
    """One of a few literal values."""
    return F.element_at(F.array(*map(F.lit, values)), (stable_index(key, len(values)) + 1).cast("int"))
