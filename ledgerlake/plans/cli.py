"""Command line for the layer jobs.

    python -m ledgerlake.plans.cli --layers all \\
        --merchants-csv s3://…/merchants.csv --transactions s3://…/txns/ --root s3://…/warehouse

On a cluster, submit ``scripts/run_layers.py`` (same arguments) with the
package on ``--py-files``.  Uses the session the launcher provides
(``getOrCreate``); the layers run in canonical order whatever order they are
given in.
"""

from __future__ import annotations

import argparse

from .layers import DEFAULT_BROADCAST_MAX_BYTES, LayerPaths, run_layers


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Run the bronze/silver/gold layer jobs")
    p.add_argument("--layers", nargs="+", default=["all"], help="bronze, silver, gold or all")
    p.add_argument("--merchants-csv", required=True, help="raw merchants CSV (file or folder)")
    p.add_argument("--transactions", required=True, help="raw transactions parquet (file or folder)")
    p.add_argument("--root", required=True, help="shared folder for the layer tables")
    p.add_argument("--broadcast-max-bytes", type=int, default=DEFAULT_BROADCAST_MAX_BYTES)
    p.add_argument("--gold-partition-by", nargs="*", default=[])
    p.add_argument("--gold-cluster-files", type=int, default=0, help="cluster Gold by month and city into this many files")
    p.add_argument("--salt-buckets", type=int, default=0)
    p.add_argument("--silver-buckets", type=int, default=0, help="write Silver in this many buckets of merchant_id")
    p.add_argument("--resume", action="store_true", help="skip tables that are already made from their present inputs")
    p.add_argument("--catalog-prefix", default="", help="namespace prefix, e.g. 'staging_'")
    p.add_argument("--bronze-register", action="store_true",
                   help="register the landed transaction parquet as Bronze instead of copying it")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> list[str]:
    from pyspark.sql import SparkSession

    args = parse_args(argv)
    paths = LayerPaths(
        merchants_csv=args.merchants_csv,
        transactions_parquet=args.transactions,
        root=args.root.rstrip("/"),
        gold_partition_by=tuple(args.gold_partition_by),
        broadcast_max_bytes=args.broadcast_max_bytes,
        salt_buckets=args.salt_buckets,
        gold_cluster_files=args.gold_cluster_files,
        silver_buckets=args.silver_buckets,
        bronze_copy_transactions=not args.bronze_register,
        catalog_prefix=args.catalog_prefix,
    )
    spark = SparkSession.builder.getOrCreate()
    return run_layers(spark, paths, args.layers, args.resume)


if __name__ == "__main__":
    main()
