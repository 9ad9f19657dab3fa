import public_tokenizers as P

import corpus_pipeline
from colloquy.llm import bpe, jaccard, mixing, quality, secrets


def test_stages_against_plain_application(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.columns == [*docs.columns, "token_ids"] and len(corpus_pipeline.STAGES) == 5
    bad = {r.doc_id for r in quality.classify(docs).collect() if r.rejected}
    good = docs.where(~docs.doc_id.isin(list(bad)))
    kept = {r.doc_id for r in jaccard.join(good).collect() if r.kept}
    clean = secrets.redact(good.where(good.doc_id.isin(list(kept))))
    want = {r.doc_id for r in mixing.sampled(clean).collect() if r.sampled}
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == want and bad and len(kept) < good.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    codec = bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for k, r in rows.items():
        assert r.text == texts[k] and codec.decode(r.token_ids).decode() == r.text and r.n_chars == len(r.text)
    assert not any(x.spans for x in secrets.digest(out).collect())


WHOLE = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = WHOLE + ", rep string, weight double, rejected boolean, token_ids string, row int"


def apply(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return corpus_pipeline.run(spark, str(path))


def test_odd_tables(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties, clashing column names."""
    prose = "The house of the family stood on a hill, and we saw it from the road near the river {}. "
    rows = [(i, "".join(prose.format(f"{i}-{k}") for k in range(4)), "en", f"s{i % 3}", 400) for i in range(30)]
    rows += [(100 + i, rows[i][1], "en", "s1", 400) for i in range(5)] + [rows[3], rows[3], (4, rows[9][1] + "another end of it", "en", "s0", 1)]
    rows += [(200, None, "en", "s0", 0), (201, "", None, "s0", 0), (202, " \n", "en", None, 2), (None, "A house on the hill by the river. " * 3, "en", "s2", 9), (None, None, None, None, None)]
    rows += [(300, "".join(prose.format(k) for k in range(9000)), "en", "s0", 1), (301, "A key: token = 'abcdefgh12345678'. " + rows[1][1][::-1], "en", "s0", None)]
    out = apply(spark, tmp_path, [(*r, "x", 0.5, True, "own", 1) for r in rows], EXTRA)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "rep", "weight", "rejected", "row", "token_ids"]
    got = out.collect()
    texts = [r.text for r in got if r.text and r.text.strip()]
    assert len(texts) == len(set(texts)) and not any("abcdefgh12345678" in t for t in texts)
    codec = bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert all(codec.decode(r.token_ids).decode() == (r.text or "") for r in got)
    known = {t for _, t, *_ in rows if t} | {r.text for r in got if r.text and "[SECRET]" in r.text}
    assert set(texts) <= known and len(got) <= len(rows)


def test_empty_table(spark, tmp_path):
    out = apply(spark, tmp_path, [], WHOLE)
    assert out.columns == [*WHOLE.replace(",", "").split()[::2], "token_ids"] and out.count() == 0
