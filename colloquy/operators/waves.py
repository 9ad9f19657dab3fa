"""Takes at full rate: the audio operators over flat Arrow buffers.

operators.audio has the short forms as column expressions, which fold over samples; ten seconds
at 24 kHz are 240 000 of them.  Here a batch's samples are one buffer, a take is a slice of it, and
all work on samples is numpy's.  Both give the same numbers (to 1e-6).

Takes with null samples are nulls of their result; other columns stay; columns that an operator
adds replace those of their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from colloquy.operators import audio as A

SCORES = "peak double, level_db double, clip_share double, silence_share double, score double"
PACKED = "left array<float>, right array<float>, user_start double, agent_start double, agent_end double, duration double"


def takes_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The samples of each row as a slice of the batch's doubles; None for a null list or one with null samples."""
    x, borders = A.flat(column)
    for valid, s, e in zip(column.is_valid().to_pylist(), borders, borders[1:]):
        y = x[s:e]
        yield None if not valid or np.isnan(y).any() else y


def lists(rows: list, kind=np.float32) -> pa.Array:
    """Arrays as one list column, their samples in one buffer."""
    borders = np.append(0, np.cumsum([0 if r is None else len(r) for r in rows])).astype(np.int32)
    flat = np.concatenate([np.empty(0, kind), *(np.asarray(r, kind) for r in rows if r is not None)])
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(flat), mask=pa.array([r is None for r in rows], pa.bool_()))


def cuts(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows, from and to, whose sizes come to at most `most`; a larger row is a run of its own."""
    upto, out, at = np.cumsum(sizes), [], 0
    while at < len(upto):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right")))
        out.append((at, end))
        at = end
    return out


def with_waves(
    rows: DataFrame, schema: str, inputs: list[str], run: Callable[[dict[str, pa.Array]], list[pa.Array]],
    parts: Callable[[dict[str, pa.Array]], list[tuple[int, int]]] | None = None,
) -> DataFrame:
    """rows with the columns of schema, which run gives for the Arrow arrays of the inputs, a batch at a time.

    parts tells the runs of rows of a batch that are to be taken one by one.
    """
    added = T.StructType.fromDDL(schema)
    kept = [c for c in rows.columns if c not in added.names]
    own = {c: f"_in{k}" for k, c in enumerate(inputs) if c not in kept}  # the others are sent once, as kept columns
    given = rows.select(*[f"`{c}`" for c in kept], *[F.col(f"`{c}`").alias(k) for c, k in own.items()])
    out = T.StructType([*rows.select(*[f"`{c}`" for c in kept]).schema, *added])
    kinds = [to_arrow_type(f.dataType) for f in added]

    def batches_of(batches):
        for whole in batches:
            for s, e in parts({c: whole.column(own.get(c, c)) for c in inputs}) if parts else [(0, whole.num_rows)]:
                batch = whole.slice(s, e - s) if parts else whole
                got = run({c: batch.column(own.get(c, c)) for c in inputs})
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(x if x.type == kind else x.cast(kind) for x, kind in zip(got, kinds))], out.names)

    return given.mapInArrow(batches_of, out)


def _each(rows: DataFrame, column: str, f: Callable[[np.ndarray], np.ndarray], kind: str = "float") -> DataFrame:
    number = np.float32 if kind == "float" else np.float64
    return with_waves(rows, f"`{column}` array<{kind}>", [column], lambda a: [lists([None if x is None else f(x) for x in takes_of(a[column])], number)])


def resampled(rows: DataFrame, rate: int, target: int, column: str = "pcm") -> DataFrame:
    return _each(rows, column, lambda x: A.resample_linear(x, rate, target))


def faded(rows: DataFrame, n: int, column: str = "pcm") -> DataFrame:
    return _each(rows, column, lambda x: A.fade_edges(x, n))


def frame_energies(rows: DataFrame, rate: int, column: str = "pcm") -> DataFrame:
    """rows with energies: root mean squares of 20 ms frames, the tail dropped; [0.0] if there is none."""
    return with_waves(rows, "energies array<double>", [column], lambda a: [lists([None if x is None else _energies(x, rate) for x in takes_of(a[column])], np.float64)])


def _energies(x: np.ndarray, rate: int) -> np.ndarray:
    return A.energies(x, rate) if len(x) >= max(int(rate * 0.02), 1) else np.zeros(1)


def _scaled(x: np.ndarray, dbfs: float) -> np.ndarray:
    return x * (10 ** (dbfs / 20) / np.sqrt(np.mean(x * x) + 1e-12)) if len(x) else x


def scaled_dbfs(rows: DataFrame, dbfs: float, column: str = "pcm") -> DataFrame:
    return _each(rows, column, lambda x: _scaled(x, dbfs), "double")


def peak_normalized(rows: DataFrame, channels: tuple[str, ...] = ("left", "right"), level: float = 0.95) -> DataFrame:
    """All channels by one factor, that of the highest peak among them; as they are if it is next to nothing."""
    def run(a):
        of = list(zip(*(takes_of(a[c]) for c in channels)))
        top = [max((float(np.abs(x).max()) for x in row if x is not None and len(x)), default=0.0) for row in of]
        return [lists([None if row[k] is None else row[k] * (level / m) if m > 1e-6 else row[k] for row, m in zip(of, top)], np.float64) for k in range(len(channels))]

    return with_waves(rows, ", ".join(f"`{c}` array<double>" for c in channels), list(channels), run)


def _score(x: np.ndarray, n_chars: int, rate: int) -> tuple:
    n = len(x)
    if not n:
        return 0.0, None, None, 1.0, A.WORST
    peak = float(np.abs(x).max())
    e = _energies(x / max(peak, 1e-8), rate)
    log_e = np.log(e + 1e-8)
    clip, silence = float((np.abs(x) > 0.99).mean()), float((e < 0.02).mean())
    level = 20 * np.log10(np.sqrt(np.mean(x * x) + 1e-12) + 1e-12)
    if n < int(0.15 * rate) or peak < 1e-4 or clip > 0.02 or silence > 0.65:
        return peak, level, clip, silence, A.WORST
    cps = max(n_chars, 1) / max(n / rate, 1e-3)
    pace = -abs(cps - 12.5) - (15.0 if cps < 4 or cps > 28 else 0.0)
    lively = log_e.std() + (0.5 * np.diff(log_e).std() if len(e) > 2 else 0.0)
    return peak, level, clip, silence, 2.5 * pace - 1.2 * abs(level + 18) + 4.0 * lively - 8.0 * silence - 40.0 * clip - 0.5 * abs(peak - 0.7)


def scored(takes: DataFrame, rate: int) -> DataFrame:
    """takes(pcm, n_chars) with peak, level_db, clip_share, silence_share and score, as audio.scored() defines them."""
    def run(a):
        rows = [(None,) * 5 if x is None else _score(x, n, rate) for x, n in zip(takes_of(a["pcm"]), a["n_chars"].to_pylist())]
        return [pa.array([r[k] for r in rows], pa.float64()) for k in range(5)]

    return with_waves(takes, SCORES, ["pcm", "n_chars"], run)


def packed_pair(rows: DataFrame, gap: float, rate: int, user: str = "user", agent: str = "agent") -> DataFrame:
    """rows with left, right and agent_start of [user][gap][agent]."""
    quiet = round(gap * rate)

    def run(a):
        left, right, start = [], [], []
        for u, g in zip(takes_of(a[user]), takes_of(a[agent])):
            whole = u is not None and g is not None
            left.append(np.concatenate((np.zeros(len(u) + quiet), g)) if whole else None)
            right.append(np.concatenate((u, np.zeros(len(g) + quiet))) if whole else None)
            start.append(len(u) / rate + gap if whole else None)
        return [lists(left, np.float64), lists(right, np.float64), pa.array(start, pa.float64())]

    return with_waves(rows, "left array<double>, right array<double>, agent_start double", [user, agent], run)


def pads(rows: DataFrame, seed: int, key: str = "id", most: float = 1.0) -> DataFrame:
    """rows with pad_pre and pad_post in seconds, drawn from the clip's own generator."""
    def run(a):
        drawn = [(r.uniform(0, most), r.uniform(0, most)) for r in (A.sample_rng(seed, i) for i in a[key].to_pylist())]
        return [pa.array([d[k] for d in drawn], pa.float64()) for k in range(2)]

    return with_waves(rows, "pad_pre double, pad_post double", [key], run)


def cropped(rows: DataFrame, n: int, seed: int, rate: int, key: str = "id", tone: str = "tone") -> DataFrame:
    """rows with crop: n samples of the row's room tone from a quiet place."""
    def run(a):
        return [lists([None if x is None else A.roomtone_crop(x.astype(np.float32), n, A.sample_rng(seed, i), rate) for i, x in zip(a[key].to_pylist(), takes_of(a[tone]))])]

    return with_waves(rows, "crop array<float>", [key, tone], run)


def packed_pool(rows: DataFrame, tone: np.ndarray, seed: int, gap: float, rate: int, pad_sec: float = 1.0, dbfs: float = -50.0, key: str = "id", user: str = "user", agent: str = "agent") -> DataFrame:
    """rows with both channels over a bed of room tone (one clip, given to all tasks) and the times of the turns.

    Paddings and the bed's place are drawn from the clip's own generator, so they do not depend on partitions.
    """
    def run(a):
        left, right, times = [], [], []
        for i, u, g in zip(a[key].to_pylist(), takes_of(a[user]), takes_of(a[agent])):
            if u is None or g is None:
                one = None, None, {}
            else:
                one = A.pack_pool(u.astype(np.float32), g.astype(np.float32), tone, A.sample_rng(seed, i), gap, rate, pad_sec, dbfs)
            for held, x in zip((left, right, times), one):
                held.append(x)
        return [lists(left), lists(right), *(pa.array([t.get(c) for t in times], pa.float64()) for c in ("user_start", "agent_start", "agent_end", "duration"))]

    return with_waves(rows, PACKED, [key, user, agent], run)
