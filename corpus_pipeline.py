"""Documents to training tokens in five stages; each reads what its predecessor wrote.

quality classifier: rejected documents go.  n-gram Jaccard join: one document of each group
stays.  secret scans: spans are masked.  mixing sources to target weights: documents are
sampled.  byte-level BPE: texts become token ids.

Defined cases: an empty table gives an empty one with the column token_ids; blank texts pass
the first three stages and have no tokens, so they are not sampled; rows without a doc_id are
judged, but not compared with others; of rows with one text, repeated ids or not, one stays;
null sources and languages are values of their own; other columns are kept, but for an own
token_ids, which the last stage replaces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import bpe, jaccard, mixing, quality, secrets
from colloquy.sources.scratch import delete, new_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.append_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", byte_bpe),
]
ORACLE_SQL = None  # the classifier and the transducer are beyond SQL; tests hold the rows against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; every result is written as Parquet in the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = new_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
        if k:
            delete(spark, f"{top}/{k - 1}")  # its successor is written
    return docs
