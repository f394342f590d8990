"""Corpus pipeline: quality rules, exact dedup, SimHash near-dedup, secret scan, packing.

Each stage takes what its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``: rejected documents and
all but one of a group of copies go, confirmed secrets are replaced in the
text.  The last returns the packed pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import documents, written
from ledgerlake.llm.filters import drop_exact_copies, drop_near_copies, keep_good
from ledgerlake.llm.packing import pack_documents
from ledgerlake.llm.quality_rules import quality_labels
from ledgerlake.llm.secret_scan import fitted, redact
from ledgerlake.llm.simhash import MAX_BITS, SHINGLE_WORDS
from ledgerlake.llm.word_tokens import vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, quality_labels(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, SHINGLE_WORDS, MAX_BITS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dictionary = vocabulary_path()
    return redact(docs, fitted(spark, dictionary), dictionary)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary_path())


STAGES = [("quality rules", quality), ("exact dedup", exact_dedup), ("simhash near-dedup", near_dedup),
          ("secret scan", secrets), ("best-fit packing", packing)]

# SQL has neither the forest nor the token ids: tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
