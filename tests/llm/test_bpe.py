import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from colloquy.llm import bpe

FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return bpe.Codec(FILE, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=400):
    rnd = random.Random(1)
    parts = ["a", "th", "ing", "é", "日本", "😀", " ", "\n", "1", "!!", "%%%", "the", "ab", "'s", "ü", "<|endoftext|>", "​"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return out + ["", "a" * 5000, "ab" * 2500, " " * 700, "日本語" * 800, "thing" * 3000, "%" * 777]


def test_as_tiktoken(both):
    codec, want = both
    for t in texts():
        ids = codec.encode(t)
        assert ids == want.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_machine_is_the_merges(both):
    codec, _ = both
    rnd = random.Random(2)
    for _ in range(300):
        piece = bytes(rnd.randrange(256) if rnd.random() < 0.2 else rnd.choice(b"thein gx") for _ in range(rnd.randint(1, 30)))
        assert codec.known.machine.encode(piece) == codec.merges.by_rank(piece)


def test_caches_are_bounded(both, monkeypatch):
    codec, want = both
    monkeypatch.setattr(bpe, "CACHED_STATES", 50)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 20)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 30)
    fresh = bpe.Codec(FILE, P.PATTERN)
    for t in texts(60):
        assert fresh.encode(t) == want.encode_ordinary(t)
    assert len(fresh.known) <= 20 and len(fresh.known.old) <= 20


def test_streaming_decode(both):
    codec, _ = both
    for t in texts(100):
        d = bpe.StreamDecoder(codec.bytes_of)
        assert "".join(map(d.feed, codec.encode(t))) + d.close() == t
    rnd = random.Random(3)
    for _ in range(500):
        raw = bytes(rnd.choice([0x61, 0xC3, 0xA9, 0xE3, 0x81, 0xF0, 0x9F, 0xED, 0xF4, 0x90, 0xFF]) for _ in range(rnd.randint(0, 9)))
        d = bpe.StreamDecoder([bytes((b,)) for b in range(256)])
        assert "".join(map(d.feed, raw)) + d.close() == raw.decode("utf-8", "replace")


def test_queries(spark, both):
    _, want = both
    docs = [(1, None, 5), (2, "", 6), (3, "the thing é", 7), (3, "the thing é", 7), (None, "x" * 9000, 8)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_tokens long")
    got = bpe.digest(df, FILE, P.PATTERN).collect()
    for (d, t, _), r in zip(docs, got):
        ids = want.encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens, r.ids_sha256) == (d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    rows = bpe.append_tokens(df, FILE, P.PATTERN).collect()
    assert [r.token_ids for r in rows] == [want.encode_ordinary(t or "") for _, t, _ in docs]
    assert bpe.append_tokens(df, FILE, P.PATTERN, "n_tokens").columns == ["doc_id", "text", "n_tokens"]
    assert bpe.digest(df.limit(0), FILE, P.PATTERN).count() == 0
