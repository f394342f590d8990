"""Whole documents from decisions: operators as filters, all columns and types kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import discard, written
from .exact_dedup import exact_duplicates
from .quality_rules import RULES, base_failed, certified_cutoffs, measures, verdict, wide_cutoffs
from .simhash import near_duplicates

# Largest table of cutoffs (a row per stratum) that is sent to every task.
CUTOFF_BYTES = 4 << 20


def _only(docs: DataFrame, stay: DataFrame, id_col: str, digest: Column, mark: str) -> DataFrame:
    """Rows of ``docs`` named by ``stay(d, m)`` (id and digest of the text), each once."""
    columns = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), docs[id_col].cast("long").alias("d0"), digest.alias("m0"))
    rows = rows.join(stay, F.col("d0").eqNullSafe(F.col("d")) & (F.col("m0") == F.col(mark)), "left_semi")
    first = Window.partitionBy("d0", "m0").orderBy("d0")
    return rows.withColumn("n0", F.row_number().over(first)).where("n0 = 1").select("row.*").select(*columns)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts (the largest id stays)."""
    found = exact_duplicates(docs, id_col, text_col)
    stay = found.where("kept").select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("m"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return _only(docs, stay, id_col, F.sha2(F.encode(text, "UTF-8"), 256), "m")


def drop_near_copies(docs: DataFrame, words: int, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each SimHash component (the smallest id stays)."""
    found = near_duplicates(docs, words, threshold, id_col, text_col)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    stay = found.groupBy("root").agg(least.alias("s")).select(F.col("s.doc_id").alias("d"), F.col("s.mark").alias("m"))
    return _only(docs, stay, id_col, F.xxhash64(docs[text_col].cast("string")), "m")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str | None = "lang", **rules) -> DataFrame:
    """``docs`` without the rows that the quality rules reject."""
    columns = docs.columns
    carried = measures(docs, id_col, text_col, stratum_col, carry=F.struct(*[docs[c] for c in columns]))
    rated = written(carried, "rated")
    cutoffs = wide_cutoffs(certified_cutoffs(rated.drop("carry"), labels, **rules))
    small, _ = broadcast_if_small(written(cutoffs, "cutoffs"), CUTOFF_BYTES)
    joined = rated.join(small, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return joined.where(verdict(rules.get("rules", RULES))).select("carry.*").select(*columns)
