"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import bpe, embed_dedup, fingerprint, html_extract, jaccard, lm, mixing, oracles, phrases, quality, secrets, substring_dedup, token_files, vector_codes

from colloquy.sources.scratch import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op6_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-ids")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        token_files.write(table(spark, sf_dir, "documents"), f.read(), folder)
    return token_files.read(spark, folder, with_ids=False)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_quality_classifier, op3_lm_scoring, op4_byte_bpe, op5_html_extraction, op6_merkle_fingerprints,
        op7_embedding_dedup, op8_substring_dedup, op9_ngram_jaccard, op10_source_mixing, op11_phrase_collocations, op12_token_files,
        op13_vector_codes,
    )
}
SQL: dict[str, str] = {
    "op1_secret_scans": secrets.sql(), "op7_embedding_dedup": oracles.EMBEDDING_DEDUP, "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_ngram_jaccard": oracles.NGRAM_JACCARD, "op10_source_mixing": mixing.sql(), "op11_phrase_collocations": phrases.sql(), "op13_vector_codes": vector_codes.sql(),
}
