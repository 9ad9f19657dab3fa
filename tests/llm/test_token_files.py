import hashlib
import pathlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from colloquy.llm import registry
from colloquy.llm import token_files as T

JSON = pathlib.Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
SCHEMA = "doc_id long, text string"


def library(texts):
    of = Tokenizer.from_str(JSON)
    return [[*e.ids, 1] for e in of.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def plain(docs):
    """(doc_id, start, n_tokens, ids_crc32) in the order of doc_id; docs have distinct ids."""
    docs, out, start = sorted(docs, key=lambda d: (d[0] is None, d[0])), [], 0
    for (i, _), ids in zip(docs, library([t for _, t in docs])):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, folder, docs, schema=SCHEMA, **options):
    T.write(spark.createDataFrame(docs, schema).repartition(3), JSON, str(folder), **options)
    got = T.read(spark, str(folder)).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1])


def test_words_give_the_ids_of_whole_texts():
    rnd = random.Random(1)
    parts = ["a", "B", "don't", "'S", "'ll", "é", "é", "́", "İ", "İ", "ΑΣ", "日本", "123", "½", "...", ".", "!?", ";", ";", "<|endoftext|>",
             "<|ENDOFTEXT|>", "<|startoftext|>x", "\x00", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　", "\n", "\r\n", "\t", " ", " ", "  ", "≠", "≮",
             ".̸", "ﬁ", "각", "가", "ᆨ", "😀", "👍🏽", "_", "-", "﻿", "U.S.A.", "x,y;z", "K", "Å", "K̀."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    for encoder in (T.Encoder(JSON, kept=50), T.Encoder(JSON, word_by_word=False)):
        got = []
        for k in range(0, len(texts), 700):
            ids, borders = encoder.ids(texts[k : k + 700])
            got += [ids[s:e].tolist() for s, e in zip(borders, borders[1:])]
        assert got == library(texts)


def test_files_come_back(spark, tmp_path):
    rnd = random.Random(2)
    words = ["alpha", "Beta.", "gamma,", "δ", "x1"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 400)))) for i in rnd.sample(range(-50, 9000), 300)]
    docs += [(10_000, "long word " * 150_000)]
    want = plain(docs)
    assert written(spark, tmp_path / "one", docs) == want
    assert written(spark, tmp_path / "many", docs, shard_bytes=900) == want
    assert len(list((tmp_path / "many").rglob("*.zids"))) > 20
    assert written(spark, tmp_path / "whole", docs[:20], word_by_word=False) == plain(docs[:20])


def test_odd_rows(spark, tmp_path):
    assert written(spark, tmp_path / "a", []) == []
    assert written(spark, tmp_path / "b", [(1, None)]) == [(1, 0, 1, zlib.crc32((1).to_bytes(4, "little")))]
    docs = [(None, "a b"), (None, None), (7, "same"), (7, "same"), (7, "other text"), (3, "")]
    got = written(spark, tmp_path / "c", docs)
    assert [r[0] for r in got] == [3, 7, 7, 7, None, None]
    assert sorted(r[2:] for r in got) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in library([t for _, t in docs]))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    wide = [(i, t, 5, "x") for i, t in docs]
    assert written(spark, tmp_path / "d", wide, SCHEMA + ", n_tokens int, frame string") == got


def test_one_document_of_a_shard():
    ids = [np.arange(k, dtype="<u2") for k in (0, 5, 70, 3)]
    dictionary = T.train([x.tobytes() for x in ids])
    import zstandard

    zip_ = zstandard.ZstdCompressor(dict_data=T._dictionary(dictionary))
    data = T.shard([1, 4, 9, None], [len(x) for x in ids], [zip_.compress(x.tobytes()) for x in ids], 2, hashlib.sha256(dictionary).digest())
    s = T.Shard(data, dictionary)
    assert [s.ids(k).tolist() for k in range(4)] == [x.tolist() for x in ids] and s.tokens == 78
    assert (s.find(4), s.find(9), s.find(5), s.find(10), s.find(0)) == (1, 2, None, None, None)
    with pytest.raises(ValueError, match="another dictionary"):
        T.Shard(data, b"x")
    with pytest.raises(ValueError, match="no shard"):
        T.Shard(b"y" * 100, dictionary)


def test_a_dictionary_helps_short_documents():
    rnd = np.random.default_rng(5)
    phrases = [rnd.integers(0, 49_000, 12) for _ in range(300)]
    docs = [np.concatenate([phrases[k] for k in rnd.integers(0, 300, 8)]).astype("<u2").tobytes() for _ in range(3000)]
    import zstandard

    dictionary = T.train(docs[:2800])
    size = lambda z: sum(len(z.compress(d)) for d in docs[2800:])
    assert size(zstandard.ZstdCompressor(dict_data=T._dictionary(dictionary))) * 2 < size(zstandard.ZstdCompressor())


def test_query_equals_the_library(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = registry.QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == plain(docs)
