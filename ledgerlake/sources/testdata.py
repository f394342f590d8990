"""Adapters from the driver's TPC-H-shaped test tables to the raw sources.

The test tables hold no merchants or card transactions, so both raw sources
are derived deterministically from them (the same derivation is written as SQL
in the oracle, see ``ledgerlake.plans.oracle``):

* one transaction per line item (line item ⋈ order ⋈ customer ⋈ nation);
* one merchant per supplier, except every tenth key (orphan transactions),
  with every fifth supplier sharing one chain name and some suppliers listed
  twice (a higher group id, or an unparseable one);
* transaction city = customer nation (nation 24 → NULL), state = its region;
* dirty categories, a midnight spike (line 1 → hour 0), date-only text for a
  few rows, NULL installments for quantity 50.

Scale notes: the line item ⋈ order join is the big one and runs as a
sort-merge join on the order key; customer joins on its key (broadcast or
sort-merge by Spark's size check); the nation table (25 rows by definition of
the schema) is small by construction, and the size threshold broadcasts it.
Only the columns used are read (parquet column pruning).
"""

from __future__ import annotations

import os
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Scans are memoised per session: resolving a parquet scan lists the files and
# reads a footer on the driver, which costs more than planning the query at
# small scale.  The test tables are read-only, so a resolved scan stays valid.
_SCANS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver test table, e.g. ``lineitem`` → ``{sf_dir}/lineitem.parquet``."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    per_session = _SCANS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


# Fixed values of the test-data mapping (must match the oracle SQL).
NO_CITY_NATION = 24          # customers of this nation have no city
ORPHAN_EVERY = 10            # supplier keys with remainder ORPHAN_REMAINDER are
ORPHAN_REMAINDER = 3         # missing from the merchant master
CHAIN_EVERY = 5              # every fifth supplier trades under CHAIN_NAME
CHAIN_NAME = "Chain Store"
DUP_EVERY = 7                # remainder 0: duplicate with group id + 100;
DUP_GROUP_OFFSET = 100       # remainder 1: duplicate with group id '' or 'inf'
DUP_SUFFIX = " DUP"


def _category(flag: Column, qty: Column) -> Column:
    is_n = flag == F.lit("N")
    return (
        F.when(is_n & (qty >= 49), F.lit(None).cast("string"))
        .when(is_n & (qty == 48), F.lit("  "))
        .otherwise(F.concat(F.lit(" "), flag))
    )


def _purchase_date(orderdate: Column, line: Column, partkey: Column,
                   orderkey: Column, qty: Column) -> Column:
    """Purchase-date text, built without the session time zone.

    ``orderdate`` is TIMESTAMP_NTZ; adding a day-time interval keeps it NTZ.
    The text comes from casts (NTZ → string, date → string), which are
    zone-free; ``date_format`` would first convert the NTZ value to a session
    timestamp and move wall clocks that fall in a daylight-saving gap.
    """
    hour = F.when(line == 1, F.lit(0)).otherwise(partkey % 24).cast("int")
    minute = (orderkey % 60).cast("int")
    ts = orderdate.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, minute, F.lit(0))
    date_only = (qty == 47) & (line == 7)
    return F.when(date_only, F.to_date(orderdate.cast("timestamp_ntz")).cast("string")).otherwise(
        ts.cast("string")
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped card transactions (12 columns, ``purchase_date`` as text)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")

    # line item ⋈ order is big ⋈ big at any scale (orders are a quarter of
    # the line items), so it is a shuffle join on the order key: the work then
    # spreads over the shuffle partitions even when a source file is a single
    # row group, where a broadcast join would keep the scan's one task.
    joined = (
        li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
    )
    line = F.col("l_linenumber")
    qty = F.col("l_quantity")
    return joined.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("M_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        (F.col("l_partkey") % 50).cast("int").alias("merchant_category_id"),
        (F.col("l_partkey") % 10).cast("int").alias("subsector_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("authorized_flag"),
        F.when(qty == 50, F.lit(None).cast("int")).otherwise((line - 1).cast("int")).alias("installments"),
        (-(line % 13)).cast("int").alias("month_lag"),
        F.col("l_extendedprice").alias("purchase_amount"),
        F.when(F.col("c_nationkey") == NO_CITY_NATION, F.lit(None).cast("int"))
        .otherwise(F.col("c_nationkey")).alias("city_id"),
        F.col("n_regionkey").alias("state_id"),
        _category(F.col("l_returnflag"), qty).alias("category"),
        _purchase_date(F.col("o_orderdate"), line, F.col("l_partkey"),
                       F.col("l_orderkey"), qty).alias("purchase_date"),
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped merchants: 9 text columns, duplicated ids, dirty group ids.

    One scan of supplier: each row is expanded in place (``explode``) into
    its master row plus, for some keys, one duplicate — no union of rescans.
    """
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    k = F.col("s_suppkey")
    # copy 0 = master row, 1 = duplicate with a higher group, 2 = unparseable group
    copies = (
        F.when(k % DUP_EVERY == 0, F.array(F.lit(0), F.lit(1)))
        .when(k % DUP_EVERY == 1, F.array(F.lit(0), F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    rows = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .filter(k % ORPHAN_EVERY != ORPHAN_REMAINDER)
        .select("s_suppkey", "s_name", "s_nationkey", "n_regionkey", F.explode(copies).alias("copy"))
    )
    copy = F.col("copy")
    group = F.col("s_nationkey")
    name = F.when(k % CHAIN_EVERY == 0, F.lit(CHAIN_NAME)).otherwise(
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" "))
    )
    return rows.select(
        F.when(copy == 0, name).otherwise(F.concat(name, F.lit(DUP_SUFFIX))).alias("merchant_name"),
        F.concat(F.lit("M_"), k.cast("string")).alias("merchant_id"),
        F.when(copy == 0, group.cast("string"))
        .when(copy == 1, (group + DUP_GROUP_OFFSET).cast("string"))
        .when(k % 2 == 0, F.lit(""))
        .otherwise(F.lit("inf"))
        .alias("merchant_group_id"),
        (k % 50).cast("string").alias("merchant_category_id"),
        (k % 10).cast("string").alias("subsector_id"),
        F.chr((k % 5) + 65).alias("most_recent_sales_range"),
        F.chr((k % 3) + 65).alias("most_recent_purchases_range"),
        group.cast("string").alias("city_id"),
        F.col("n_regionkey").cast("string").alias("state_id"),
    )


def raw_merchants_csv_layout(raw: DataFrame) -> DataFrame:
    """Widen 9-column raw merchants to the 20-column CSV layout (NULL filler)."""
    from .schemas import MERCHANT_CSV_COLUMNS

    return raw.select(
        *[
            F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c)
            for c in MERCHANT_CSV_COLUMNS
        ]
    )
