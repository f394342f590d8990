"""Sources and sinks: raw-file scans, test-data adapters, layer tables."""

from .files import read_merchants_csv, read_transactions_parquet, write_merchants_csv, write_parquet
from .schemas import GOLD_COLUMNS, MERCHANTS_RAW_SCHEMA, MERCHANT_CSV_COLUMNS
from .tables import ensure_namespaces, overwrite_table, read_layer_table
from .testdata import raw_merchants, raw_merchants_csv_layout, raw_transactions, read_table

__all__ = [
    "GOLD_COLUMNS",
    "MERCHANTS_RAW_SCHEMA",
    "MERCHANT_CSV_COLUMNS",
    "ensure_namespaces",
    "overwrite_table",
    "raw_merchants",
    "raw_merchants_csv_layout",
    "raw_transactions",
    "read_layer_table",
    "read_merchants_csv",
    "read_table",
    "read_transactions_parquet",
    "write_merchants_csv",
    "write_parquet",
]
