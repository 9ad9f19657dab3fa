"""Token ids in files: every document a zstandard frame of its own, with one shared dictionary.

Documents are encoded by a tokenizer of the tokenizers library, an end id is appended, and the
ids are serialized as little-endian integers of two bytes (four for larger vocabularies).  A
zstandard dictionary is trained on the serialized arrays of a sample; every document is compressed with
it separately, so that a short document can be read without its neighbours and still compresses well.

A shard file (name `ids-<part>-<number>-<documents>-<ids>.zids`, in the order of doc_id):

    header   magic ZIDS, version, bytes of an id, documents, ids (8 bytes each), SHA-256 of the dictionary
    frames   one for each document
    index    for all documents: doc_id, number of ids, end of the frame (8 bytes each), has it a doc_id (1 byte)

The names say how many ids a shard holds, so where each begins follows from a listing.
The dictionary lies beside the shards as `dictionary-<its SHA-256>.zdict`.

Words parted by ASCII white space are encoded once in a batch and kept in a bounded cache.
`word_by_word` states what this rests on: the tokenizer's normalizer and splitter never join or
reorder characters over white space, nor over the border of an ASCII letter and one of .,;:!?,
and a word of letters up to U+00FF is lower-cased, one piece, and given to the model by its bytes.  For a tokenizer of which
that is not true, pass word_by_word=False, and whole texts are encoded.

Hot keys: rows are dealt by ranges of (doc_id, hash), so one id may spread over ranges; no
groups.  A task holds a batch of texts, or one shard.

Defined cases: a null or empty text is its end id alone; a null doc_id comes last; repeated
ids are documents of their own, in the order of a hash of their frames; a very long text is one
frame; an empty table gives a dictionary and no shard; if a dictionary cannot be trained (a
handful of short texts), the sample itself is the dictionary; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.llm import common as C
from colloquy.llm import words as W
from colloquy.sources.files import read_files, write_files

END_ID = 1
#: The sample that the dictionary is trained on: documents of up to so many bytes, and the dictionary's size.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8 << 10, 64 << 10
LEVEL = 3
CHUNK_BYTES = 3 << 20  # text encoded at once
SHARD_BYTES = 4 << 20
PART_BYTES = 16 << 20  # frames of a range of documents
SPAN = 1024  # ranges whose sizes are added in one window
KEPT_WORDS = 500_000

MAGIC = b"ZIDS"
HEADER = struct.Struct("<4sBBxxQQ32s")
INDEX_BYTES = 25
LETTER, STOP = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
STOP[list(b".,;:!?")] = True
#: Words of letters up to U+00FF, which are one piece; and the characters that stand for bytes in byte-level vocabularies.
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+ ")
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
AS_CHARACTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in SHOWN)}
SPACES = bytes(32 if 9 <= c <= 13 else c for c in range(256))


# ---------------------------------------------------------------- encoding
@lru_cache(maxsize=4)
def _tokenizer(text: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


class Encoder:
    """Texts to ids.  The words met before and their ids are kept as Arrow and numpy arrays, up to a number of words; beyond
    it only those of the last texts stay."""

    def __init__(self, tokenizer: str, end_id: int = END_ID, word_by_word: bool = True, kept: int = KEPT_WORDS):
        self.of, self.end_id, self.word_by_word, self.kept = _tokenizer(tokenizer), end_id, word_by_word, kept
        self.model = self.of.model
        self.known = pa.array([b"\n "], pa.binary())  # the end of a text
        self.flat, self.starts, self.lengths = np.array([end_id], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Adds words that are not known."""
        ids: list = [None] * len(words)
        letters: dict[str, array] = {}
        for k, w in enumerate(words):
            if LATIN.fullmatch(w):
                low = w[:-1].decode().lower()
                if (x := letters.get(low)) is None:
                    letters[low] = x = array("I", [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(AS_CHARACTERS))])
                ids[k] = x
        rest = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(rest, self.encode([words[k].decode("utf-8", "replace") for k in rest])):
            ids[k] = array("I", x)
        n = np.array([len(x) for x in ids], np.int64)
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(n) - n)
        self.lengths = np.append(self.lengths, n)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(x.tobytes() for x in ids), np.uint32))
        self.known = pa.concat_arrays([self.known, pa.array(words, pa.binary())])

    def _forget(self, used: np.ndarray) -> None:
        """Keeps the used words, the end of a text first."""
        used = np.unique(np.append(0, used))
        n = self.lengths[used]
        self.flat, self.starts, self.lengths = self.flat[W.ranges(self.starts[used], n)], np.cumsum(n) - n, n
        self.known = self.known.take(pa.array(used))

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, borders of the documents), the end id after each."""
        if not self.word_by_word:
            every = [np.array([*x, self.end_id], np.uint32) for x in self.encode([t or "" for t in texts])]
            return np.concatenate(every), np.append(0, np.cumsum([len(x) for x in every]))
        raw = b" \n ".join([*((t or "").encode("utf-8", "surrogatepass").translate(SPACES) for t in texts), b""])
        b = np.frombuffer(raw, np.uint8)
        numbers, words = W.dictionary(np.insert(b, np.flatnonzero(LETTER[b[:-1]] & STOP[b[1:]]) + 1, 32).tobytes())
        of = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(of < 0)
        if len(new):
            of[new] = len(self.known) + np.arange(len(new))
            self._learn(words.take(pa.array(new)).to_pylist())
        place = of[numbers]
        n = self.lengths[place]
        ids, borders = self.flat[W.ranges(self.starts[place], n)], np.append(0, np.cumsum(n)[place == 0])
        if len(self.known) > self.kept:
            self._forget(of)
        return ids, borders


@lru_cache(maxsize=2)
def _encoder(tokenizer: str, end_id: int, word_by_word: bool) -> Encoder:
    """One for each worker process, with its cache."""
    return Encoder(tokenizer, end_id, word_by_word)


def _serialized(tokenizer: str, end_id: int, word_by_word: bool, width: int):
    """Batches -> (doc_id, number of ids, serialized ids) in chunks of bounded text."""
    def run(batch):
        encoder = _encoder(tokenizer, end_id, word_by_word)
        texts, at = batch.column("text"), 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK_BYTES, "right")))
            ids, borders = encoder.ids(texts.slice(at, to - at).to_pylist())
            data = ids.astype(f"<u{width}").tobytes()
            yield batch.column("doc_id").slice(at, to - at), np.diff(borders), [data[s * width : e * width] for s, e in zip(borders, borders[1:])]
            at = to

    return run


def _sample(tokenizer: str, end_id: int, word_by_word: bool, width: int):
    def run(batches):
        for batch in batches:
            for _, _, data in _serialized(tokenizer, end_id, word_by_word, width)(batch):
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    return run


def _frames(tokenizer: str, end_id: int, word_by_word: bool, width: int, dictionary: bytes):
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
        for batch in batches:
            for doc_id, n, data in _serialized(tokenizer, end_id, word_by_word, width)(batch):
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(n, pa.int64()), pa.array(map(zip_.compress, data), pa.binary())], ["doc_id", "n_tokens", "frame"])

    return run


# ---------------------------------------------------------------- dictionary
@lru_cache(maxsize=2)
def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples, or their last bytes if they are too few to train one."""
    if sum(map(len, samples)) >= 8 * size:
        return zstandard.train_dictionary(size, samples).as_bytes()
    return b"".join(samples)[-size:] or bytes(8)


# ---------------------------------------------------------------- shards
def shard(doc_ids: list[int | None], counts: list[int], frames: list[bytes], width: int, dictionary_hash: bytes) -> bytes:
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    index = [ids, np.array(counts, "<i8"), np.cumsum([len(f) for f in frames]).astype("<i8"), np.array([d is not None for d in doc_ids], np.uint8)]
    return b"".join([HEADER.pack(MAGIC, 1, width, len(frames), sum(counts), dictionary_hash), *frames, *(x.tobytes() for x in index)])


class Shard:
    """A shard's bytes (or a map of its file): its index, and single documents."""

    def __init__(self, data, dictionary: bytes):
        self.data = memoryview(data)
        magic, version, self.width, n, self.tokens, of = HEADER.unpack_from(self.data)
        if magic != MAGIC or version != 1:
            raise ValueError("no shard of token ids")
        if of != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        at = len(self.data) - n * INDEX_BYTES
        self.doc_ids, self.counts, self.ends = (np.frombuffer(self.data, "<i8", n, at + 8 * n * k) for k in range(3))
        self.known = np.frombuffer(self.data, np.uint8, n, at + 24 * n).astype(bool)
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.counts)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document; nothing else is decompressed."""
        begin = HEADER.size + (int(self.ends[k - 1]) if k else 0)
        data = self.unzip.decompress(self.data[begin : HEADER.size + int(self.ends[k])])
        return np.frombuffer(data, f"<u{self.width}").astype(np.uint32)

    def find(self, doc_id: int) -> int | None:
        """The place of a document by binary search; None if it is not here."""
        k = int(np.searchsorted(self.doc_ids[: int(self.known.sum())], doc_id))
        return k if k < len(self) and self.known[k] and self.doc_ids[k] == doc_id else None


def _shards(width: int, dictionary_hash: bytes, shard_bytes: int):
    """Sorted rows of a range -> (name, content) of its shards."""

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, ([], [], []), 0

        def out():
            name = f"ids-{part:07d}-{number:06d}-{len(held[0])}-{sum(held[1])}.zids"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([shard(*held, width, dictionary_hash)], pa.binary())], ["name", "content"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                for h, v in zip(held, row):
                    h.append(v)
                size += len(row[2])
                if size >= shard_bytes:
                    yield out()
                    number, held, size = number + 1, ([], [], []), 0
        if held[0]:
            yield out()

    return run


# ---------------------------------------------------------------- tables
def _short(rows: DataFrame) -> DataFrame:
    """At most SAMPLE_DOCS short documents by a hash: those below a bound that leaves a few more than needed, of these the lowest."""
    short = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    n = short.agg(F.approx_count_distinct(F.xxhash64("text"), 0.02)).first()[0]  # copies share a hash and count once
    key = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    drawn = short.where(key < int(min(1.0, 1.2 * SAMPLE_DOCS / max(1, n)) * (1 << 30)))
    return drawn.groupBy("text").agg(F.min("doc_id").alias("doc_id")).orderBy(F.xxhash64("text")).limit(SAMPLE_DOCS)


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, word_by_word: bool = True, shard_bytes: int = SHARD_BYTES) -> None:
    """docs(doc_id, text) -> shards and dictionary in the folder.  tokenizer: the JSON text of a tokenizers file."""
    spark = docs.sparkSession
    width = 2 if max(_tokenizer(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    how = (tokenizer, end_id, word_by_word, width)
    sample = [r.data for r in _short(rows).mapInArrow(_sample(*how), "data binary").collect()]  # at most SAMPLE_DOCS of SAMPLE_BYTES
    dictionary = train(sample)
    of = hashlib.sha256(dictionary)
    frames = C.materialize(rows.mapInArrow(_frames(*how, dictionary), "doc_id long, n_tokens long, frame binary"))
    size = frames.agg(F.sum(F.octet_length("frame") + 24)).first()[0] or 0
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("frame")]
    ranged = frames.repartitionByRange(max(1, -(-size // PART_BYTES)), *order).sortWithinPartitions(*order, "frame")
    write_files(spark.createDataFrame([(f"dictionary-{of.hexdigest()}.zdict", dictionary)], "name string, content binary"), folder)
    write_files(ranged, folder, build=_shards(width, of.digest(), shard_bytes))


def dictionary_of(spark: SparkSession, folder: str) -> bytes:
    (row,) = read_files(spark, folder, "dictionary-*.zdict").select("path", "content").collect()  # one file of bounded size
    if hashlib.sha256(row.content).hexdigest() != row.path.rpartition("dictionary-")[2].removesuffix(".zdict"):
        raise ValueError("the dictionary's bytes differ from its name")
    return bytes(row.content)


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """part, number, base: how many ids lie before each shard, from the names of the files alone."""
    name = F.regexp_extract("path", r"ids-(\d+)-(\d+)-\d+-(\d+)\.zids$", 0)
    cut = F.split(F.substring_index(name, ".", 1), "-")
    listed = read_files(spark, folder, "ids-*.zids").select(*(cut[k].cast("long").alias(c) for k, c in ((1, "part"), (2, "number"), (4, "tokens"))))
    span = F.floor(F.col("part") / SPAN)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    whole = listed.groupBy(span.alias("span")).agg(F.sum("tokens").alias("tokens"))
    base = whole.select("span", F.coalesce(F.sum("tokens").over(before.orderBy("span")), F.lit(0)).alias("below"))  # a row for each SPAN ranges
    within = listed.withColumn("span", span).withColumn("own", F.coalesce(F.sum("tokens").over(before.partitionBy("span").orderBy("part", "number")), F.lit(0)))
    return within.join(base, "span").select("part", "number", (F.col("own") + F.col("below")).alias("base"))


READ = "part long, number long, doc_id long, own long, n_tokens long, ids_crc32 long"


def _read(dictionary: bytes, with_ids: bool):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                s = Shard(content.as_buffer(), dictionary)
                part, number = map(int, path.rpartition("ids-")[2].split("-")[:2])
                every = [s.ids(k) for k in range(len(s))]
                cols = [
                    pa.array([part] * len(s), pa.int64()), pa.array([number] * len(s), pa.int64()), pa.array(s.doc_ids.astype(np.int64), mask=~s.known),
                    pa.array(np.cumsum(s.counts) - s.counts), pa.array([len(x) for x in every], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in every], pa.int64()),
                ]
                names = ["part", "number", "doc_id", "own", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int64) for x in every], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The folder's documents: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    dictionary = dictionary_of(spark, folder)
    files = read_files(spark, folder, "ids-*.zids").select("path", "content")
    rows = files.mapInArrow(_read(dictionary, with_ids), READ + ", ids array<long>" * with_ids)
    out = rows.join(starts(spark, folder), ["part", "number"])
    return out.select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
