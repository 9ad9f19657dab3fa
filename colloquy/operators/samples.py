"""Manifest rows to training samples: weights, shards, chunks, frame tokens, context, batches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.operators.waves import with_waves
from colloquy.sources.scratch import materialize

RATE, CHUNK_SEC, BUDGET = 12.5, 40.0, 120
PAD, END_OF_PAD, IN_WORD, ZERO = 3, 0, -2, -1
BOS, EOS = 1, 2
SILENCE, SINE = -10, -20


def step_sec(chunk_sec: float = CHUNK_SEC, rate: float = RATE, budget: int = BUDGET) -> float:
    """Seconds between chunk starts: the chunk's frames less the prompt's budget."""
    return (math.ceil(chunk_sec * rate) - budget) / rate


def source_weights(text: str) -> list[tuple[str, float]]:
    """'path[:weight],...' with weights normalised to 1."""
    found: dict[str, float] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        path, *weight = part.split(":")
        if len(weight) > 1:
            raise ValueError(f"more than one colon: {part!r}")
        w = float(weight[0]) if weight else 1.0
        if w <= 0:
            raise ValueError(f"weight not positive: {part!r}")
        if path in found:
            raise ValueError(f"source given twice: {path!r}")
        found[path] = w
    if not found:
        raise ValueError("no sources")
    every = sum(found.values())
    return [(p, w / every) for p, w in found.items()]


def global_index(rows: DataFrame, *order: str, name: str = "i") -> DataFrame:
    """rows with their place in a global order, without bringing them to one task.

    Range partitioning sorts; each partition numbers its rows; sums of the partitions' sizes,
    one row for each partition, are the offsets.
    """
    # partition and place are fixed by writing the ordered rows once
    parted = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    kept = materialize(parted)
    part = F.shiftright("_m", 33).cast("int")  # the id holds the partition, then the row in it
    sizes = kept.groupBy(part.alias("_p")).agg(F.count("*").alias("n")).collect()  # one row for each partition
    offset, at = [], 0
    for r in sorted(sizes, key=lambda r: r["_p"]):
        offset.append((r["_p"], at))
        at += r["n"]
    starts = rows.sparkSession.createDataFrame(offset, "_p int, _o long")
    local = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn(name, F.col("_o") + local).drop("_p", "_m", "_o")


def shard_assign(indexed: DataFrame, world: int, name: str = "i") -> DataFrame:
    return indexed.withColumn("rank", F.pmod(name, F.lit(world)).cast("int")).withColumn("seq", F.floor(F.col(name) / world))


def numbered_by_source(items: DataFrame) -> DataFrame:
    """items(source, item) with j, each source's own count from 0 in the order of item.

    The global index less the source's lowest one: a heavy source is not brought to one task.
    """
    indexed = global_index(items, "source", "item")
    low = indexed.groupBy("source").agg(F.min("i").alias("_low"))
    return indexed.join(F.broadcast(low), "source").withColumn("j", F.col("i") - F.col("_low")).drop("i", "_low")  # one row for each source


def epoch_key(seed: int, epoch: Column | int, key: str) -> Column:
    """Sort key of an epoch's permutation: the seed grows by one with every pass."""
    e = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat((F.lit(seed) + e).cast("string"), F.lit(":"), F.col(key).cast("string")))


def mix_sources(draws: DataFrame, items: DataFrame, weights: list[tuple[str, float]], seed: int) -> DataFrame:
    """draws(draw), items(source, j, item), j from 0: each draw takes the next item of a source picked by weight.

    Sources cycle.  The pick is a hash of the draw in the cumulative weights (a few literals);
    the join key is (source, j), so a heavy source is not one key.
    """
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    top, pick = 0.0, F.lit(weights[-1][0])
    bounds = []
    for path, w in weights[:-1]:
        top += w
        bounds.append((path, top))
    for path, t in reversed(bounds):
        pick = F.when(u < t, path).otherwise(pick)
    sizes = items.groupBy("source").agg(F.count("*").alias("n_items"))
    drawn = draws.withColumn("source", pick)
    # how many draws of the source came before: counted in ranges of draws, then within a range
    drawn = drawn.withColumn("_b", F.floor(F.col("draw") / 4096))
    before = drawn.groupBy("source", "_b").agg(F.count("*").alias("c")).withColumn("_o", F.coalesce(F.sum("c").over(Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy("source", "_b").orderBy("draw")) - 1
    drawn = drawn.withColumn("_l", local).join(before.select("source", "_b", "_o"), ["source", "_b"]).withColumn("turn", F.col("_o") + F.col("_l"))
    drawn = drawn.join(F.broadcast(sizes), "source").withColumn("j", F.col("turn") % F.col("n_items"))  # one row for each source
    return drawn.select("draw", "source", "j").join(items, ["source", "j"])


def chunk_clips(clips: DataFrame, step: float) -> DataFrame:
    """A row for each k with k*step < duration: chunk, start_sec."""
    most = F.greatest(F.ceil(F.col("duration") / step).cast("int"), F.lit(1))
    out = clips.where("duration > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), most)))
    return out.where(F.col("chunk") * F.lit(step) < F.col("duration")).withColumn("start_sec", F.col("chunk") * F.lit(step))


def chunk_of(start: Column, step: float) -> Column:
    """floor(start / step), corrected where the division rounds over an edge k*step."""
    k = F.floor(start / step)
    return F.when(start < k * F.lit(step), k - 1).when(start >= (k + 1) * F.lit(step), k + 1).otherwise(k)


def window_alignments(words: DataFrame, step: float) -> DataFrame:
    """words(clip, pos, start_sec, end_sec) with their chunk, times counted from its start."""
    k = words.withColumn("chunk", chunk_of(F.col("start_sec"), step)).where("chunk >= 0")
    base = F.col("chunk") * F.lit(step)
    return k.withColumn("start_sec", F.col("start_sec") - base).withColumn("end_sec", F.col("end_sec") - base)


def carried_lag(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], value: str, name: str) -> DataFrame:
    """rows with the value of the row before in the same group, in a global order of (by, order).

    Rows lie in ranges of that order, written once; lag() reaches within a range, and the first row of a group in a range
    takes what the range before carries over: its last row, one for each range.  A group that holds all rows is thus spread
    over all ranges.
    """
    kept = materialize(rows.repartitionByRange(*[F.col(c) for c in (*by, *order)]).withColumn("_p", F.spark_partition_id()))
    group = F.struct(*by)
    last = kept.groupBy("_p").agg(F.max_by(F.struct(group.alias("g"), F.col(value).alias("v")), F.struct(*by, *order)).alias("r"))
    carried = [(r["_p"], r["r"]["g"], r["r"]["v"]) for r in last.orderBy("_p").collect()]  # one row for each range
    kinds = last.select("_p", "r.g", "r.v").schema
    before = rows.sparkSession.createDataFrame([(p, g, v) for (_, g, v), (p, _, _) in zip(carried, carried[1:])], kinds).toDF("_p", "_g", "_v")
    near = F.lag(value).over(Window.partitionBy("_p", *by).orderBy(*order))
    first = F.row_number().over(Window.partitionBy("_p", *by).orderBy(*order)) == 1
    out = kept.withColumn(name, near).withColumn("_f", first).join(F.broadcast(before), "_p", "left")  # one row for each range
    return out.withColumn(name, F.when(F.col("_f") & (F.col("_g") == group), F.col("_v")).otherwise(F.col(name))).drop("_p", "_f", "_g", "_v")


def lag_in_spans(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], value: str, name: str, span: float) -> DataFrame:
    """As carried_lag(), for a number as the first column of the order: ranges are its spans, which a projection gives.

    One exchange by (by, span): lag() reaches within a span, and the first row of a span takes the last value of the group's
    span before, of which there is one row for each span.  Nothing is written, and no task has more than a span's rows.
    """
    x = F.col(order[0]).cast("double")
    ends = F.lit(-1 << 63), F.lit((1 << 63) - 1)  # nulls sort first, NaN last
    place = F.when(F.isnan(x), ends[1]).otherwise(F.coalesce(F.floor(x / span), ends[0]))
    cut = rows.withColumn("_k", F.struct(*by, place.alias("_r")))  # as one key, whose null fields are equal
    w = Window.partitionBy("_k").orderBy(*order)
    out = cut.withColumn(name, F.lag(value).over(w)).withColumn("_f", F.row_number().over(w) == 1)
    # a struct, as the last value may be null
    last = cut.groupBy("_k").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_v"))
    before = last.withColumn("_v", F.lag("_v").over(Window.partitionBy(*[f"_k.{c}" for c in by]).orderBy("_k._r"))).where("_v is not null")
    out = out.join(before, "_k", "left")
    return out.withColumn(name, F.when(F.col("_f"), F.col("_v.v")).otherwise(F.col(name))).drop("_k", "_v", "_f")


def turn_markers(words: DataFrame, main: str = R.SPEAKER_AGENT, by: tuple[str, ...] = ("clip",), span: float = 600.0) -> DataFrame:
    """words with marker: 'bos' where the main speaker begins, 'eos' where another follows the main one.

    Words lie in spans of so many seconds of their clip; None: in ranges that are sampled and written, for clips whose times
    do not tell words apart.
    """
    order = "start_sec", "pos"
    out = lag_in_spans(words, by, order, "speaker", "_b", span) if span else carried_lag(words, by, order, "speaker", "_b")
    mark = F.when(F.col("speaker").eqNullSafe(F.col("_b")), None).when(F.col("speaker") == main, "bos").when(F.col("_b") == main, "eos")
    return out.withColumn("marker", mark).drop("_b")


def main_speaker_words(words: DataFrame, main: str = R.SPEAKER_AGENT) -> DataFrame:
    return words.where((F.col("speaker") == main) & (F.col("start_sec") < F.col("end_sec")))


def shift_delay(words: DataFrame, delay: float) -> DataFrame:
    """Drops words that end by the delay and moves the others back by it."""
    kept = words.where(F.col("end_sec") > delay)
    return kept.withColumn("start_sec", F.col("start_sec") - delay).withColumn("end_sec", F.col("end_sec") - delay)


def text_stream(words: DataFrame, frames: int, rate: float = RATE, by: tuple[str, ...] = ("clip", "chunk")) -> DataFrame:
    """words(by, pos, start_sec, end_sec, tokens array<int>) -> by, stream array<int> of `frames` ids.

    A frame takes the last word that starts in it; the word gives its tokens one a frame
    until the next word's frame; the frame before it, if padding, becomes end-of-padding;
    frames up to the word's end after its tokens are in-word padding.  Windows are by chunk,
    whose words are few.
    """
    at = F.greatest(F.floor(F.col("start_sec") * rate), F.lit(0)).cast("int")
    last = F.max_by(F.struct("tokens", F.expr(f"int(end_sec * {rate})").alias("end")), F.struct("start_sec", "pos"))
    one = words.withColumn("f", at).where(F.col("f") < frames).groupBy(*by, "f").agg(last.alias("w"))
    w = Window.partitionBy(*by).orderBy("f")
    spans = one.select(*by, "f", "w.tokens", "w.end", F.lead("f", 1, frames).over(w).alias("next_f"))
    emitted = F.slice("tokens", 1, F.col("next_f") - F.col("f"))
    n = F.least(F.size("tokens"), F.col("next_f") - F.col("f"))
    rest = F.col("next_f") - F.col("f") - n
    inside = F.greatest(F.least(F.col("end") + 1, F.col("next_f")) - F.col("f") - n, F.lit(0))
    body = F.concat(emitted, F.array_repeat(F.lit(IN_WORD), inside), F.array_repeat(F.lit(PAD), rest - inside))
    lists = spans.select(*by, "f", n.alias("n"), body.alias("body")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("f", "n", "body"))).alias("s"))  # at most `frames` entries
    first = F.element_at("s", 1)["f"]
    flat = F.concat(F.array_repeat(F.lit(PAD), first), F.flatten(F.transform("s", lambda x: x["body"])))
    marks = F.transform(F.filter("s", lambda x: (x["n"] > 0) & (x["f"] > 0)), lambda x: x["f"] - 1)
    out = lists.withColumn("flat", flat).withColumn("marks", marks)
    done = F.transform("flat", lambda v, i: F.when(v.isin(PAD, IN_WORD) & F.array_contains("marks", i), F.lit(END_OF_PAD)).otherwise(v))
    return out.select(*by, done.alias("stream"))


def queue_stream(tokens: list, starts: list, ends: list, frames: int, rate: float = RATE) -> list[int]:
    """The stream of one chunk when tokens queue instead of being cut by the next word.

    A word's tokens begin at its frame or where those before it end, whichever is later: a
    running maximum of frames less the tokens before, as all words move in order.
    """
    out = np.full(frames, PAD)
    if not len(starts):
        return out.tolist()
    first = np.maximum(np.floor(np.asarray(starts) * rate), 0).astype(int)
    count = np.array([len(t) for t in tokens])
    before = np.cumsum(count) - count
    begin = np.maximum.accumulate(first - before) + before
    now = np.searchsorted(first, np.arange(frames), "right") - 1  # the word begun last at each frame
    until = np.trunc(np.asarray(ends) * rate)
    out[(now >= 0) & (np.arange(frames) <= until[now])] = IN_WORD
    at = np.concatenate([b + np.arange(n) for b, n in zip(begin, count)]).astype(int)
    flat = np.concatenate([np.asarray(t, int) for t in tokens])
    at, flat = at[at < frames], flat[at < frames]
    out[np.setdiff1d(at[at > 0] - 1, at)] = END_OF_PAD
    out[at] = flat
    return out.tolist()


def queue_streams(words: pa.Array, frames: int, rate: float = RATE) -> pa.Array:
    """queue_stream() of many chunks at once: lists of (start_sec, ..., end_sec, tokens) in order, over flat buffers.

    The running maximum of all chunks is one: each chunk's numbers are lifted above those of the chunks before it.
    """
    counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    flat, of, chunks = words.flatten(), np.repeat(np.arange(len(counts)), counts), np.arange(len(counts))
    out = np.full(len(counts) * frames, PAD, np.int32)
    if len(flat):
        number = lambda c: pc.struct_field(flat, c).cast(pa.float64()).to_numpy(zero_copy_only=False)
        tokens = pc.struct_field(flat, "tokens")
        n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy().astype(np.int64)
        first = np.clip(np.floor(number("start_sec") * rate), 0, frames).astype(np.int64)  # what begins later is never seen
        total = np.cumsum(n) - n
        before = total - np.repeat(total[(np.cumsum(counts) - counts)[counts > 0]], counts[counts > 0])
        free = first - before
        low, width = free.min(), np.ptp(free) + 1
        begin = np.maximum.accumulate(free - low + of * width) - of * width + low + before
        # the word begun last at each frame
        t, chunk = np.tile(np.arange(frames), len(counts)), np.repeat(chunks, frames)
        now = np.searchsorted(of * (frames + 1) + first, chunk * (frames + 1) + t, "right") - 1
        until = np.trunc(number("end_sec") * rate)
        out[(now >= 0) & (of[now] == chunk) & (t <= until[now])] = IN_WORD
        at = np.repeat(begin - total, n) + np.arange(n.sum())
        seen = at < frames
        at, place, ids = at[seen], (np.repeat(of, n) * frames + at)[seen], tokens.flatten().to_numpy()[seen]
        out[place[at > 0] - 1] = END_OF_PAD
        out[place] = ids
    return pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * frames), pa.array(out))


def text_stream_queue(words: DataFrame, frames: int, rate: float = RATE, by: tuple[str, ...] = ("clip", "chunk")) -> DataFrame:
    rows = words.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("start_sec", "pos", "end_sec", "tokens"))).alias("w"))  # a chunk's words
    return with_waves(rows, "stream array<int>", ["w"], lambda a: [queue_streams(a["w"], frames, rate)]).select(*by, "stream")


def pad_streams(text: Column, audio: Column, conv_frames: Column, rate: float = RATE, seconds: bool = False) -> tuple[Column, Column]:
    """Text and audio of conv_frames ids.

    The text stream is made for ceil(frames * rate) ids (a frame count stands where seconds
    are meant; seconds=True makes it the audio's own length), then cut or padded with ZERO.
    """
    n_audio = F.least(F.size(audio), conv_frames)
    made = n_audio if seconds else F.ceil(n_audio * F.lit(rate)).cast("int")
    cut = lambda c, n: F.slice(c, 1, F.greatest(n, F.lit(0)))
    fill = lambda c, n, v: F.concat(c, F.array_repeat(F.lit(v), F.greatest(n - F.size(c), F.lit(0))))
    full = fill(cut(text, made), made, PAD)
    return fill(cut(full, conv_frames), conv_frames, ZERO), fill(cut(audio, conv_frames), conv_frames, ZERO)


def system_prompt(text_tokens: Column, voice: Column, silence: int, frames: int) -> tuple[Column, Column, Column]:
    """(text row, agent row, user row) of [voice][silence][text][silence], cut to frames - 1."""
    v, n = F.coalesce(F.size(voice), F.lit(0)), F.size(text_tokens)
    total = v + n + 2 * silence
    cut = lambda c: F.slice(c, 1, F.least(total, F.lit(frames - 1)))
    text = F.concat(F.array_repeat(F.lit(PAD), v + silence), text_tokens, F.array_repeat(F.lit(PAD), silence))
    agent = F.concat(F.coalesce(voice, F.array().cast("array<int>")), F.array_repeat(F.lit(SILENCE), n + 2 * silence))
    return cut(text), cut(agent), cut(F.array_repeat(F.lit(SINE), total))


def voice_prompt_codes(clips: DataFrame, codes: DataFrame) -> DataFrame:
    """clips(path, voice) with the codes of their voice file; a relative one lies beside the clip."""
    base = F.regexp_replace("path", "[^/]*$", "")
    full = F.when(F.col("voice").startswith("/"), F.col("voice")).otherwise(F.concat(base, "voice"))
    return clips.withColumn("voice_path", full).join(codes, "voice_path", "left")


def placements(injections: DataFrame, conv_frames: int, chunk_frame: Column | int = 0, by: tuple[str, ...] = ("clip_no",)) -> DataFrame:
    """Injections inside the window with offset (their own) and at (after those before them moved things), if they are seen.

    Each has a token at least, so the first conv_frames of a clip are all that begin in the
    window: a top-k, which tasks cut before the shuffle, however many injections a clip has.
    """
    base = chunk_frame if isinstance(chunk_frame, Column) else F.lit(chunk_frame)
    rows = injections.withColumn("offset", F.col("frame_offset") - base).where((F.col("offset") >= 0) & (F.col("offset") < conv_frames) & (F.col("n_tokens") > 0))
    order = Window.partitionBy(*by).orderBy("offset", "pos")
    rows = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= conv_frames).drop("_n")
    before = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("at", (F.col("offset") + F.coalesce(before, F.lit(0))).cast("int")).where(F.col("at") < conv_frames)


def inject_context(placed: DataFrame, text: Column, agent: Column, user: Column, conv_frames: int, by: tuple[str, ...] = ("clip_no",)) -> DataFrame:
    """Rows of text, agent and user frames with every block put in, cut to conv_frames.

    A block silences the agent and lets the user's displaced frames be heard; past the end
    the user is silent.  text, agent and user are the frames before, from columns of `by`.
    placed has tokens array<int>.
    """
    lists = placed.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "tokens"))).alias("blocks"))  # conv_frames entries at most

    def put(rows: Column, new: Column, at: Column) -> Column:
        return F.slice(F.concat(F.slice(rows, 1, at), new, F.slice(rows, at + 1, conv_frames)), 1, conv_frames)  # what is past the end stays unseen

    def step(a: Column, b: Column) -> Column:
        n, at = F.size(b["tokens"]), b["at"]
        heard = F.slice(a["user"], at + 1, n)
        block = F.concat(heard, F.array_repeat(F.lit(SILENCE), n - F.size(heard)))
        return F.struct(
            put(a["text"], b["tokens"], at).alias("text"), put(a["agent"], F.array_repeat(F.lit(SILENCE), n), at).alias("agent"), put(a["user"], block, at).alias("user"))

    kind = "struct<text:array<int>,agent:array<int>,user:array<int>>"
    start = F.struct(text.alias("text"), agent.alias("agent"), user.alias("user")).cast(kind)
    out = lists.withColumn("r", F.aggregate("blocks", start, lambda a, b: step(a, b).cast(kind)))
    return out.select(*by, *[F.slice(F.col(f"r.{c}"), 1, conv_frames).alias(c) for c in ("text", "agent", "user")])


def context_mask(placed: DataFrame, conv_frames: int, prompt_length: int = 0, by: tuple[str, ...] = ("clip_no",)) -> DataFrame:
    """True on the frames of blocks, false elsewhere and on the prompt before; null if no block is in reach."""
    lists = placed.groupBy(*by).agg(F.collect_list(F.struct("at", (F.col("at") + F.col("n_tokens")).alias("to"))).alias("r"))  # conv_frames entries at most
    hit = F.transform(F.sequence(F.lit(0), F.lit(conv_frames - 1)), lambda i: F.exists("r", lambda x: (i >= x["at"]) & (i < x["to"])))
    mask = F.concat(F.array_repeat(F.lit(False), prompt_length), hit)
    return lists.select(*by, F.when(F.exists(hit, lambda x: x), mask).alias("mask"))


def injection_stats(injections: DataFrame, conv_frames: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Counters, place rate (of those in the window) and token yield.

    Blocks are put in between frames, so all in the window are placed and none is truncated or
    dropped for overlap or space; blocks cut off the tail count as placed.
    """
    inside = (F.col("frame_offset") >= 0) & (F.col("frame_offset") < conv_frames)
    out = injections.groupBy(*by).agg(
        F.count("*").alias("total"), F.count(F.when(inside, 1)).alias("in_window"), F.count(F.when(inside, 1)).alias("placed"),
        *[F.lit(0).cast("long").alias(c) for c in ("truncated", "drop_anchor_overlap", "drop_no_space", "drop_final_overlap")],
        F.count(F.when(F.col("frame_offset").isNull(), 1)).alias("drop_no_offset"),
        F.count(F.when(F.col("frame_offset").isNotNull() & ~inside, 1)).alias("drop_out_of_window"),
        F.coalesce(F.sum(F.when(inside, F.col("n_tokens"))), F.lit(0)).alias("tokens_placed"), F.sum("n_tokens").alias("tokens_requested"))
    return out.withColumn("place_rate", F.round(F.try_divide("placed", "in_window"), 6)).withColumn("token_yield", F.round(F.col("tokens_placed") / F.col("tokens_requested"), 6))


def assemble_codes(prompt: Column, conversation: Column) -> Column:
    """The rows of a sample (text, the agent's codebooks, the user's): prompt, then conversation, row by row.

    Both are array<array<int>> with as many rows; without a prompt (null) the conversation stands alone.
    """
    return F.coalesce(F.zip_with(prompt, conversation, lambda p, c: F.concat(p, c)), conversation)


def collate_batches(sharded: DataFrame, size: int) -> DataFrame:
    """Full batches of each rank; seq counts a rank's samples from 0, so no window over a rank is needed."""
    out = sharded.withColumn("batch", F.floor(F.col("seq") / size))
    full = out.groupBy("rank", "batch").agg(F.count("*").alias("n")).where(F.col("n") == size).select("rank", "batch")
    return out.join(full, ["rank", "batch"])


def steps_per_epoch(n_rows: DataFrame, batch: int, micro: int, world: int) -> DataFrame:
    return n_rows.agg(F.floor(F.count("*") / (batch * micro * world)).alias("steps"))
