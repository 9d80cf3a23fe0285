"""The corpus pipeline: quality classifier, near-dedup, decontamination, secret scan, byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return the
columns of ``docs``. Null, empty and repeated rows are treated as the operators say: the classifier rejects texts
without words, near-dedup drops repeated rows, the others keep what they don't reject.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sectora.llm import bpe, decontaminate, near_dedup, quality_knn, secret_scan
from sectora.llm.common import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects."""
    return quality_knn.accepted(docs, read(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return near_dedup.deduplicated(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the text decoded from them."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), extra=("ids",))


STAGES = [("quality", quality), ("near_dedup", dedup), ("decontamination", decontamination), ("secrets", secrets), ("bpe", encode)]

#: The classifier's arithmetic, the sampling hashes and byte-pair merging have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
