"""Raw-source scans and the landing writers used to stage them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import MERCHANTS_RAW_SCHEMA


def read_merchants_csv(spark: SparkSession, path: str) -> DataFrame:
    """Merchants CSV with a header row and the declared all-text schema.

    Columns bind by position (header names are not enforced); quoted and
    unquoted empty fields read as NULL, short rows pad with NULL and long rows
    are truncated.  No schema inference pass over the file is made.
    """
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .schema(MERCHANTS_RAW_SCHEMA)
        .csv(path)
    )


def read_transactions_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Card transactions: a parquet file or directory, schema from the files."""
    return spark.read.parquet(path)


def write_merchants_csv(df: DataFrame, path: str) -> None:
    """Land merchants as header CSV (full refresh of ``path``), spaces kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    """Land a DataFrame as parquet (full refresh of ``path``)."""
    df.write.mode("overwrite").parquet(path)
