"""Files in and out: JSON lines, voice lists, sidecars, manifests, WAV, metric feeds.

Schemas are given, never inferred.  Paths go through Spark's readers and writers only, so
any store that Spark knows will do.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import audio as A
from colloquy.operators import clips as C
from colloquy.operators.waves import cuts
from colloquy.sources.files import read_files, write_files
from colloquy.sources.scratch import materialize

USERS = "user_id string, curr_emotion string, topic string, text string"
DIALOGUES = "id string, user_id string, curr_emotion string, res_emotion string, user_text string, agent_text string, topic string"
VOICES = "speakers array<struct<id:string,wav:string,text:string,gender:string>>"
SIDECAR = (
    "id string, user_id string, text_prompt string, voice_prompt string, duration double, sample_rate int, "
    "alignments string, "
    "styletalk struct<curr_emotion:string,res_emotion:string,topic:string,user_id:string>, "
    "turns array<struct<index:int,speaker:string,start:double,end:double,text:string,role:string,path:string>>, "
    "context_injections array<struct<frame_offset:int,text:string>>, gap_sec double, pad_pre_sec double, pad_post_sec double, "
    "user_roomtone string, user_roomtone_dbfs double, aligner string, channel_layout struct<left:string,right:string>, "
    "voices struct<agent:struct<name:string,gender:string,path:string,text:string>,user:struct<name:string,gender:string,path:string,text:string>>, "
    "tagged_text struct<user:string,agent:string>, wav string, _corrupt string"
)
MANIFEST = "path string, duration double"
METRICS = "step long, at timestamp, tag string, loss double"


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without the blank ones."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    out = _lines(spark, path, USERS)
    return out.withColumn("topic", F.coalesce("topic", F.lit(""))).withColumn("text", T.clean_utterance(F.col("text")))


def read_dialogues(spark: SparkSession, path: str) -> DataFrame:
    out = _lines(spark, path, DIALOGUES).withColumn("topic", F.coalesce("topic", F.lit("")))
    for c in ("user_text", "agent_text"):
        out = out.withColumn(c, T.clean_utterance(F.col(c)))
    return out


def read_voices(spark: SparkSession, folder: str) -> DataFrame:
    """The speakers of folder/manifest.json in order; a text that is missing comes from the .txt beside the wav."""
    s = spark.read.schema(VOICES).json(f"{folder}/manifest.json", multiLine=True).select(F.posexplode("speakers").alias("pos", "s"))
    if s.count() < 2:
        raise ValueError("fewer than two speakers")
    path = F.when(F.col("s.wav").startswith("/") | F.col("s.wav").contains("://"), F.col("s.wav")).otherwise(F.concat(F.lit(f"{folder}/"), "s.wav"))
    stem = F.regexp_replace(F.substring_index("s.wav", "/", -1), r"\.[^.]*$", "")
    texts = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.txt").load(folder)
    beside = texts.select(F.regexp_replace(F.substring_index(F.input_file_name(), "/", -1), r"\.txt$", "").alias("stem"), T.trim(F.col("value")).alias("beside"))
    out = s.select("pos", F.coalesce(F.nullif("s.id", F.lit("")), stem).alias("name"), F.upper(F.coalesce("s.gender", F.lit(""))).alias("gender"), F.nullif(F.trim("s.text"), F.lit("")).alias("own"), path.alias("path"), stem.alias("stem"))
    return out.join(beside, "stem", "left").select("pos", "name", "gender", F.coalesce("own", "beside").alias("text"), "path")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the store that it lies in spells it, as read_files() tells it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def read_voice_audio(spark: SparkSession, folder: str, rate: int, *more: str) -> DataFrame:
    """read_voices() with sample_rate and pcm, mono at the rate; pcm is null if a voice's file is in none of the folders.

    more: folders that the list names by absolute paths.  A file that several voices name is decoded once; files that
    write_files() committed go by the names they were given (of equal ones the first by path).
    """
    voices = read_voices(spark, folder)
    heard = read_audio(spark, folder, rate)
    for other in more:
        heard = heard.unionByName(read_audio(spark, other, rate))
    given = F.regexp_replace("path", "/job-[0-9a-f]{32}/[0-9a-f]{32}/", "/")
    heard = heard.groupBy(given.alias("_file")).agg(F.min_by("pcm", "path").alias("pcm"))
    base, root = _qualified(spark, folder), _qualified(spark, "/").rstrip("/")
    file = F.when(F.col("path").contains("://"), F.regexp_replace("path", "^file:/+", "file:/")).when(F.col("path").startswith(f"{folder}/"), F.concat(F.lit(base), F.substr("path", F.lit(len(folder) + 1))))
    file = file.when(F.col("path").startswith("/"), F.concat(F.lit(root), "path")).otherwise(F.col("path"))
    out = voices.withColumn("_file", file).join(heard, "_file", "left")
    return out.select("pos", "name", "gender", "text", "path", F.lit(rate).alias("sample_rate"), "pcm")


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """One record for each file; a file that is no JSON has duration 0.0 and readable false, one without text is none.

    Files are read whole and parsed in memory: the JSON reader takes every nested list that is asked for as text by a
    positioned read of its own from the file, one for each word.
    """
    texts = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    return _parsed(texts.where(T.trim(F.col("value")) != ""))


def read_sidecar_lines(spark: SparkSession, path: str) -> DataFrame:
    """The records of a dataset of lines, as write_sidecars() writes them."""
    return _parsed(spark.read.text(path))


def _parsed(texts: DataFrame) -> DataFrame:
    return records(texts.select(F.from_json("value", SIDECAR, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*"))


def records(out: DataFrame) -> DataFrame:
    """Parsed sidecars with flat alignments; those that are no JSON are not readable and last 0.0."""
    @F.arrow_udf(f"array<{ALIGNMENT}>")
    def aligned(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        return pa.concat_arrays([pa.array([], _ALIGNMENTS), *(_aligned(texts.slice(s, e - s)) for s, e in cuts(sizes, AT_ONCE))])

    out = out.withColumn("_flat", aligned("alignments"))
    whole = F.col("_corrupt").isNull() & (F.col("alignments").isNull() | F.col("_flat").isNotNull())
    return out.withColumn("readable", whole).withColumn("duration", F.coalesce("duration", F.lit(0.0))).withColumn("alignments", F.col("_flat")).drop("_corrupt", "_flat")


ALIGNMENT = "struct<word:string,start:double,end:double,speaker:string>"
_ALIGNMENT = pa.struct([("word", pa.string()), ("start", pa.float64()), ("end", pa.float64()), ("speaker", pa.string())])
_ALIGNMENTS = pa.list_(_ALIGNMENT)
AT_ONCE = 4 << 20  # bytes of text parsed at once


def _aligned(texts: pa.Array) -> pa.Array:
    """Lists of [word, [start, end], speaker] from their JSON texts; null for a text that is no list of lists."""
    plain = _plain(texts)
    if plain is not None:
        return plain
    lists = [None if t is None else _loaded(t) for t in texts.to_pylist()]
    return pa.array([None if x is None else [_alignment(a) for a in x] for x in lists], _ALIGNMENTS)


def _plain(texts: pa.Array) -> pa.Array | None:
    """_aligned() of texts without white space and escapes, all at once by their quotes; None if one of them is of another form."""
    if pc.any(pc.match_substring(texts, "\\")).as_py():
        return None
    parts = pc.split_pattern(texts, '"')  # of a word: [[ or ],[ then the word, its times, its speaker
    sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy()
    if (sizes[sizes > 0] % 4 != 1).any():
        return None
    flat, of = parts.flatten(), np.repeat(sizes, sizes)
    at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pick = lambda x, where: x.take(pa.array(np.flatnonzero(where)))
    between = at % 4 == 0
    want = np.select([of == 1, at == 0, at == of - 1], [0, 1, 2], 3)[between]
    if not pick(flat, between).equals(pa.array(["[]", "[[", "]]", "],["]).take(pa.array(want))):
        return None
    word, times, speaker = (pick(flat, at % 4 == k) for k in (1, 2, 3))
    if pc.any(pc.not_equal(pc.count_substring(times, ","), 3)).as_py():
        return None
    cut = pc.split_pattern(times, ",").flatten()
    before, start, end, after = (cut.take(pa.array(np.arange(k, len(cut), 4))) for k in range(4))
    bare = pc.utf8_ltrim(start, "["), pc.utf8_rtrim(end, "]")
    rest = [before, after, *(pc.subtract(pc.binary_length(x), pc.add(pc.binary_length(y), 1)) for x, y in zip((start, end), bare))]
    if any(pc.any(pc.not_equal(x, "" if k < 2 else 0)).as_py() for k, x in enumerate(rest)):
        return None
    try:
        seconds = [x.cast(pa.float64()) for x in bare]
    except pa.ArrowInvalid:  # null, or no number
        return None
    if not all(pc.all(pc.is_finite(x)).as_py() for x in seconds):
        return None
    offsets = pa.array(np.append(0, np.cumsum(sizes // 4)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([word, *seconds, speaker], fields=list(_ALIGNMENT)), mask=texts.is_null())


def _loaded(text: str) -> list | None:
    try:
        x = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return x if type(x) is list and all(a is None or type(a) is list for a in x) else None


def _alignment(a: list | None) -> tuple:
    """One alignment of any kinds: texts of what is no text, null for what is no number or not there."""
    word, times, speaker = [*(a or []), None, None, None][:3]
    if isinstance(times, str):
        times = [_number(x) for x in times.strip("[] ").split(",")]
    start, end = [*(times if type(times) is list else [times]), None, None][:2]
    text = lambda x: x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    second = lambda x: _number(x) if type(x) in (int, float) else None
    return text(word), second(start), second(end), text(speaker)


def _number(x) -> float | None:
    try:
        y = float(x)
    except (ValueError, OverflowError):
        return None
    return y if math.isfinite(y) else None


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path, recursiveFileLookup=True, pathGlobFilter="*jsonl")


def count_manifest_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of all sources, blank ones too, whatever their weights."""
    return spark.read.text(paths, recursiveFileLookup=True).agg(F.count("*").alias("n"))


def read_audio(spark: SparkSession, path: str, rate: int) -> DataFrame:
    """path, pcm: mono floats at the rate, of every WAV below the path."""
    files = read_files(spark, path, "*.wav")

    @F.pandas_udf("array<float>")
    def decode(content: pd.Series) -> pd.Series:
        return content.map(lambda b: A.decode_wav(b, rate))

    return files.select("path", decode("content").alias("pcm"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """JSON lines; text beyond ASCII stays readable."""
    rows.write.mode("errorifexists").json(path)


def write_manifests(split: DataFrame, path: str, fraction: float, seed: int) -> None:
    """Folders of JSON lines: train, val, split_manifest (what was asked, and the sides of each mapping), val_indices,
    manifest_by_mapping (count and seconds of each mapping) and mapping_ids (the clips of each, a line for each clip: a
    list in one line has no bound)."""
    mapping = F.concat_ws("->", "curr_emotion", "res_emotion").alias("mapping")
    split = materialize(split.select("id", "path", "duration", "curr_emotion", "res_emotion", "index", "split"))  # the split is made once
    for side in ("train", "val"):
        write_lines(split.where(F.col("split") == side).select("path", "duration"), f"{path}/{side}.jsonl")
    write_lines(C.split_report(split, fraction, seed), f"{path}/split_manifest.json")
    write_lines(C.val_indices(split), f"{path}/val_indices.json")
    write_lines(split.groupBy(mapping).agg(F.count("*").alias("count"), F.sum("duration").alias("total_duration_sec")), f"{path}/manifest_by_mapping.json")
    write_lines(split.select(mapping, "id"), f"{path}/mapping_ids.json")


def write_sidecars(rows: DataFrame, path: str) -> None:
    """One JSON text for each clip in a dataset, not a file for each: millions of small files help nobody."""
    rows.select("sidecar").write.mode("errorifexists").text(path)


def write_audio(clips: DataFrame, path: str, rate: int) -> None:
    """clips(id, left, right or null) -> a Parquet table of ids and WAV bytes."""
    @F.pandas_udf("binary")
    def encode(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([A.encode_wav([x] if y is None else [x, y], rate) for x, y in zip(left, right)])

    clips.select("id", encode("left", "right").alias("wav")).write.mode("errorifexists").parquet(path)


def file_name(clip_id: str, suffix: str):
    """A name that every store takes: characters other than letters, digits and . - _ * are escaped."""
    return F.concat(F.replace(F.url_encode(clip_id), F.lit("%"), F.lit("~")), F.lit(suffix))


def file_id(path: str = "path"):
    """The id that file_name() was given."""
    return F.url_decode(F.replace(F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1), F.lit("~"), F.lit("%")))


def write_audio_files(clips: DataFrame, folder: str, rate: int, replace: bool = False) -> None:
    """clips(id, left, right or null) -> a committed file <id>.wav for each."""
    rows = clips.select(file_name("id", ".wav").alias("name"), *(F.col(c).cast("array<float>").alias(c) for c in ("left", "right")))
    write_files(rows, folder, replace, A.wav_batches(rate))


def write_sidecar_files(rows: DataFrame, folder: str, replace: bool = False) -> None:
    """rows(id, sidecar) -> a committed file <id>.json for each."""
    write_files(rows.select(file_name("id", ".json").alias("name"), F.encode("sidecar", "UTF-8").alias("content")), folder, replace)


def output_index(spark: SparkSession, folder: str) -> DataFrame:
    """What is there: id, has_wav, has_sidecar, wav_bytes, sidecar_bytes, by names and sizes of committed files alone.

    Empty files do not count; of an id that several jobs wrote, the largest file's size is told.
    """
    listed = read_files(spark, folder, "*.{wav,json}").select("path", "length").where("length > 0")
    kind = F.substring_index("path", ".", -1)
    size = lambda k: F.coalesce(F.max(F.when(kind == k, F.col("length"))), F.lit(0))
    out = listed.withColumn("id", file_id()).groupBy("id").agg(size("wav").alias("wav_bytes"), size("json").alias("sidecar_bytes"))
    return out.select("id", (F.col("wav_bytes") > 0).alias("has_wav"), (F.col("sidecar_bytes") > 0).alias("has_sidecar"), "wav_bytes", "sidecar_bytes")
