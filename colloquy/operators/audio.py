"""Takes of samples: energies, scores, levels, packing.

Short forms are column expressions; what draws random numbers, interpolates or reads WAV is
a small numpy helper applied to Arrow batches.
"""

from __future__ import annotations

import hashlib
import io
import random
import struct
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FADE_SEC, BANG_RATIO, TRIES = 0.015, 4.0, 24
WORST = -1e6


def doubles(c: Column) -> Column:
    return F.transform(c, lambda x: x.cast("double"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once; inside a lambda an outer expression would be computed at every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(c: Column, f) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + f(x))


def frame_energies(x: Column, rate: int) -> Column:
    """Root mean squares of 20 ms frames, the tail dropped; [0.0] if there is none."""
    n = max(int(rate * 0.02), 1)
    count = F.floor(F.size(x) / n).cast("int")
    of = lambda k: F.sqrt(_sum(F.slice(x, k * n + 1, n), lambda v: v * v) / n + F.lit(1e-12))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), of)).otherwise(F.array(F.lit(0.0)))


def peak(x: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(x, F.abs)), F.lit(0.0))


def _spread(c: Column) -> Column:
    """Population standard deviation."""
    return _let(_sum(c, lambda v: v) / F.size(c), lambda mean: F.sqrt(_sum(c, lambda v: (v - mean) * (v - mean)) / F.size(c)))


def scored(takes: DataFrame, rate: int) -> DataFrame:
    """takes(pcm, n_chars) with peak, level_db, clip_share, silence_share and score.

    Scores fall with distance from 12.5 characters a second, -18 dBFS and a peak of 0.7, with
    silence and clipping, and rise with the spread of the frames' log energies; takes that
    are too short, silent or clipped get the worst one.
    """
    x = doubles(F.col("pcm"))
    out = takes.withColumn("x", x).withColumn("peak", peak(F.col("x"))).withColumn("n", F.size("x"))
    unit = F.transform("x", lambda v: v / F.greatest("peak", F.lit(1e-8)))
    out = out.withColumn("e", frame_energies(unit, rate)).withColumn("log_e", F.transform("e", lambda v: F.log(v + 1e-8)))
    share = lambda c, f: F.size(F.filter(c, f)) / F.size(c)
    out = out.withColumn("clip_share", share(F.col("x"), lambda v: F.abs(v) > 0.99)).withColumn("silence_share", share(F.col("e"), lambda v: v < 0.02))
    rms = F.sqrt(_sum(F.col("x"), lambda v: v * v) / F.col("n") + F.lit(1e-12))
    out = out.withColumn("level_db", 20 * F.log10(rms + 1e-12))
    cps = F.greatest("n_chars", F.lit(1)) / F.greatest(F.col("n") / float(rate), F.lit(1e-3))
    pace = -F.abs(cps - 12.5) - F.when((cps < 4) | (cps > 28), 15.0).otherwise(0.0)
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.size("log_e") - 1, F.lit(1))), lambda i: F.coalesce(F.try_element_at("log_e", i + 1), F.lit(0.0)) - F.element_at("log_e", i))
    liveliness = _spread(F.col("log_e")) + F.when(F.size("e") > 2, 0.5 * _spread(steps)).otherwise(0.0)
    bad = (F.col("n") < int(0.15 * rate)) | (F.col("peak") < 1e-4) | (F.col("clip_share") > 0.02) | (F.col("silence_share") > 0.65)
    score = (
        2.5 * pace - 1.2 * F.abs(F.col("level_db") + 18) + 4.0 * liveliness - 8.0 * F.col("silence_share")
        - 40.0 * F.col("clip_share") - 0.5 * F.abs(F.col("peak") - 0.7)
    )
    return out.withColumn("score", F.when(bad, WORST).otherwise(score)).drop("x", "n", "e", "log_e")


def best_take(takes: DataFrame) -> DataFrame:
    """Of each id the take with the highest score, the lowest number at ties.  Narrow rows only: samples are joined later."""
    best = takes.groupBy("id").agg(F.min_by(F.struct("take", "score"), F.struct(-F.col("score"), F.col("take"))).alias("b"))
    return best.select("id", "b.take", "b.score")


def weak_takes(takes: DataFrame) -> DataFrame:
    return takes.withColumn("weak", F.col("score") <= -1e5)


def scale_dbfs(x: Column, target: float) -> Column:
    rms = F.sqrt(_sum(x, lambda v: v * v) / F.size(x) + F.lit(1e-12))
    return _let(F.lit(10 ** (target / 20)) / rms, lambda by: F.transform(x, lambda v: v * by))


def peak_normalize(x: Column, top: Column, level: float = 0.95) -> Column:
    """x scaled so that `top`, the peak of both channels, is at level; as it is if top is next to nothing."""
    return F.when(top > 1e-6, _let(level / top, lambda by: F.transform(x, lambda v: v * by))).otherwise(x)


def pack_pair(user: Column, agent: Column, gap: float, rate: int) -> tuple[Column, Column, Column]:
    """(left, right, agent_start) of [user][gap][agent]; the start is told with the unrounded gap."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    quiet = round(gap * rate)
    left = F.concat(zeros(F.size(user) + quiet), agent)
    right = F.concat(user, zeros(F.size(agent) + quiet))
    return left, right, F.size(user) / float(rate) + gap


# ---------------------------------------------------------------- numpy helpers
def resample_linear(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    if not len(x) or rate == target:
        return np.asarray(x, np.float32)
    n = max(round(len(x) * target / rate), 1)
    return np.interp(np.arange(n) / n, np.arange(len(x)) / len(x), x).astype(np.float32)


def sample_rng(seed: int, clip_id: str) -> random.Random:
    """A generator that depends on seed and clip only, hence not on partitions."""
    return random.Random(int.from_bytes(hashlib.sha256(f"{seed}:{clip_id}".encode()).digest()[:8], "little"))


def energies(x: np.ndarray, rate: int) -> np.ndarray:
    n = max(int(rate * 0.02), 1)
    k = len(x) // n
    return np.sqrt((np.asarray(x[: k * n], np.float64).reshape(k, n) ** 2).mean(1) + 1e-12) if k else np.zeros(1)


def roomtone_crop(tone: np.ndarray, n: int, rng: random.Random, rate: int) -> np.ndarray:
    """n samples from a random place, going round; places with a bang are tried again, the last try stands."""
    if n <= 0 or not len(tone):
        return np.zeros(max(n, 0), np.float32)
    limit = max(float(np.median(energies(tone, rate))) * BANG_RATIO, 1e-8)
    for _ in range(TRIES):
        start = rng.randrange(len(tone)) if len(tone) > 1 else 0
        crop = np.take(tone, np.arange(start, start + n), mode="wrap")
        if energies(crop, rate).max() <= limit:
            break
    return crop


def fade_edges(x: np.ndarray, n: int) -> np.ndarray:
    out, n = np.array(x, np.float64), min(n, len(x) // 2)
    if n > 0:
        t = np.linspace(0, np.pi / 2, n)
        out[:n] *= np.sin(t)
        out[-n:] *= np.cos(t)
    return out.astype(np.float32)


def pack_pool(user: np.ndarray, agent: np.ndarray, tone: np.ndarray, rng: random.Random, gap: float, rate: int, pad_sec: float = 1.0, dbfs: float = -50.0):
    """(left, right, times): a room-tone bed under the whole right channel, silence around the agent."""
    pre, post = (round(rng.uniform(0, pad_sec) * rate) for _ in range(2))
    gap_n = round(gap * rate)
    at = pre + len(user) + gap_n
    n = at + len(agent) + post
    bed = roomtone_crop(tone, n, rng, rate).astype(np.float64)
    right = (bed * (10 ** (dbfs / 20) / np.sqrt((bed**2).mean() + 1e-12))).astype(np.float32) if n else np.zeros(0, np.float32)
    right[pre : pre + len(user)] += fade_edges(user, round(FADE_SEC * rate))
    left = np.zeros(n, np.float32)
    left[at : at + len(agent)] = agent
    return left, right, {"user_start": pre / rate, "agent_start": at / rate, "agent_end": (at + len(agent)) / rate, "duration": n / rate}


def decode_wav(data: bytes, target: int | None = None) -> np.ndarray:
    """WAV of 8, 16, 24 or 32 bit integers to mono floats (the channels' mean), at the target rate."""
    with wave.open(io.BytesIO(data)) as f:
        raw, width = f.readframes(f.getnframes()), f.getsampwidth()
        if width == 1:  # the only one without sign
            x = np.frombuffer(raw, np.uint8).astype(np.float64) - 128
        elif width == 3:
            wide = np.zeros((len(raw) // 3, 4), np.uint8)
            wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
            x = wide.view("<i4").ravel() / 256
        else:
            x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float64)
        x = x.reshape(-1, f.getnchannels()).mean(1) / 2 ** (8 * width - 1)
        return resample_linear(x.astype(np.float32), f.getframerate(), target or f.getframerate())


def encode_wav(channels: list, rate: int) -> bytes:
    x = np.clip(np.stack([np.asarray(c, np.float64) for c in channels], 1), -1, 1)
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as f:
        f.setnchannels(x.shape[1])
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.round(x * 32767).astype("<i2").tobytes())
    return buffer.getvalue()


# ---------------------------------------------------------------- Arrow batches
def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all samples of a batch as doubles, borders of the rows); null rows are empty, null samples NaN."""
    borders = np.zeros(len(column) + 1, np.int64)
    borders[1:] = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), borders


def wav_batches(rate: int):
    """Batches of (name, left, right or null) to (name, content)."""

    def run(batches):
        for batch in batches:
            (left, at), (right, to) = flat(batch.column("left")), flat(batch.column("right"))
            whole = [np.round(np.clip(np.nan_to_num(x), -1, 1) * 32767).astype("<i2") for x in (left, right)]
            stereo = batch.column("right").is_valid().to_numpy(zero_copy_only=False)
            out = []
            for k in range(batch.num_rows):
                data = whole[0][at[k] : at[k + 1]]
                if stereo[k]:
                    data = np.stack((data, whole[1][to[k] : to[k + 1]]), 1)
                channels = 1 + int(stereo[k])
                head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + data.nbytes, b"WAVE", b"fmt ", 16, 1, channels, rate, 2 * channels * rate, 2 * channels, 16, b"data", data.nbytes)
                out.append(head + data.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.binary())], ["name", "content"])

    return run


def wav_contents(clips: DataFrame, rate: int) -> DataFrame:
    """clips(name, left, right or null) -> name, content: 16-bit WAV, mono or stereo, converted a batch at a time."""
    wide = clips.select("name", *(F.col(c).cast("array<float>").alias(c) for c in ("left", "right")))
    return wide.mapInArrow(wav_batches(rate), "name string, content binary")
