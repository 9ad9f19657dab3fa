"""Words of many texts as Arrow dictionaries: no Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def single_spaced(raw: bytes) -> np.ndarray:
    """The bytes with one space after every word and none before the first."""
    b = np.frombuffer(raw, np.uint8)
    space = b == 32
    keep = np.empty(len(b), bool)
    keep[:1] = ~space[:1]
    np.logical_or(~space[1:], ~space[:-1], out=keep[1:])
    out = b[keep]
    return out if not len(out) or out[-1] == 32 else np.append(out, np.uint8(32))


def dictionary(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """(number of each word, the distinct words, each with a space at its end); words are parted by spaces (0x20) only."""
    data = single_spaced(raw)
    ends = np.flatnonzero(data == 32)
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends + 1
    words = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    found = words.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def codes(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word, the distinct words)."""
    numbers, words = dictionary(raw)
    return numbers, [w[:-1] for w in words.to_pylist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges starts[k]:starts[k]+lengths[k], one after another."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
