"""Stored partial states of the questions' measures, and all evidence reports from one pass.

A money total is kept as the parts of ``functions.money`` (whole units,
decimals, plain-double rest) and means as total and count, so states of any
two sets of rows add up to the state of both: a rollup is merged with that of
new months, and questions regroup it instead of reading Gold.  Distinct counts
are kept as bitmaps, merged by OR.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import DEFAULT_PROFIT_MODEL, ProfitModel, money_parts, money_value, month_label_of, profit_factor

# The finest groups that the questions ask for.
ROLLUP_KEYS = ["txn_month_key", "city_id", "state_id", "merchant_name", "category", "txn_hour"]
# The groups of the evidence for a new merchant, one report each.
EVIDENCE_KEYS = ["city_id", "category", "txn_month_key", "txn_hour", "installments"]
_PARTS = ["whole", "units", "rest"]


def _states(df: DataFrame) -> dict[str, Column]:
    """The mergeable aggregates of sales rows, or of states made before."""
    if "amount_whole" in df.columns:
        return {name: F.sum(name) for name in (*(f"amount_{p}" for p in _PARTS), "amounts", "sales")}
    parts = money_parts(F.col("purchase_amount"))
    return {**{f"amount_{p}": parts[p] for p in _PARTS}, "amounts": F.count("purchase_amount"), "sales": F.count("*")}


def measures(df: DataFrame) -> dict[str, Column]:
    """Aggregates ``total``, ``mean`` (of non-NULL amounts) and ``sales`` over Gold rows or a rollup's states."""
    states = _states(df)
    total = money_value({p: states[f"amount_{p}"] for p in _PARTS})
    return {"total": total, "mean": F.try_divide(total, states["amounts"].cast("double")), "sales": states["sales"]}


def sales_rollup(gold: DataFrame) -> DataFrame:
    """One row of states per month, city, state, merchant name, category and hour (NULL is a group of its own).

    Partial aggregation before the one shuffle, so a hot group costs a row per
    map task.  ``txn_month_label`` follows from the key.
    """
    rolled = gold.groupBy(*ROLLUP_KEYS).agg(*[c.alias(name) for name, c in _states(gold).items()])
    return rolled.withColumn("txn_month_label", month_label_of(F.col("txn_month_key")))


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """The rollup of all rows that ``rollups`` stand for (each row in one of them)."""
    return sales_rollup(reduce(DataFrame.unionByName, rollups))


def rollup_totals(rollup: DataFrame) -> DataFrame:
    """A rollup's groups with their total and number of sales."""
    m = measures(rollup)
    return rollup.groupBy(*ROLLUP_KEYS).agg(m["total"].alias("purchase_total"), m["sales"].alias("no_of_sales"))


def distinct_states(gold: DataFrame) -> DataFrame:
    """Mergeable exact states of Gold's distinct cities, states and categories.

    One row per category and block of 32,768 city and state ids, with a bitmap
    of the ids met in each: one partial aggregation, no row is multiplied as a
    plan of several DISTINCT counts does.  NULL is a block, or a category, of its own.
    """
    blocks = {"city_block": F.bitmap_bucket_number("city_id"), "state_block": F.bitmap_bucket_number("state_id")}
    return gold.groupBy(*[c.alias(name) for name, c in blocks.items()], "category").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("city_id")).alias("cities"),
        F.bitmap_construct_agg(F.bitmap_bit_position("state_id")).alias("states"))


def merge_distinct_states(*states: DataFrame) -> DataFrame:
    """The states of all rows that ``states`` stand for (rows may be in several)."""
    return reduce(DataFrame.unionByName, states).groupBy("city_block", "state_block", "category").agg(
        F.bitmap_or_agg("cities").alias("cities"), F.bitmap_or_agg("states").alias("states"))


def distinct_profile_of(states: DataFrame) -> DataFrame:
    """Distinct cities, states and categories (NULL counted as a value) of :func:`distinct_states`."""
    def entry(what: str, block: Column, name: Column, bits: str) -> Column:
        return F.struct(F.lit(what).alias("what"), block.alias("block"), name.alias("name"), F.col(bits).alias("bits"))

    unnamed = F.lit(None).cast("string")
    entries = F.array(entry("cities", F.col("city_block"), unnamed, "cities"), entry("states", F.col("state_block"), unnamed, "states"),
                      entry("categories", F.lit(None).cast("long"), F.col("category"), "cities"))
    each = states.select(F.explode(entries).alias("e")).select("e.*").groupBy("what", "block", "name").agg(F.bitmap_or_agg("bits").alias("bits"))
    ids = F.when(F.col("block").isNull(), F.lit(1).cast("long")).otherwise(F.bitmap_count("bits"))
    return each.agg(*[F.coalesce(F.sum(F.when(F.col("what") == name, ids)), F.lit(0).cast("long")).alias(name)
                      for name in ("cities", "states", "categories")])


def merchant_evidence(gold: DataFrame) -> DataFrame:
    """Revenue, transactions and average ticket per city, category, month, hour and installment count, in one pass.

    GROUPING SETS: Gold is scanned once and each task passes on one partial
    row per group.  ``part`` names the key a row is grouped by; the other keys
    are NULL there.  Kept as a table, it answers every report of
    :func:`evidence_report`.
    """
    m = measures(gold)
    part = F.coalesce(*[F.when(F.grouping(k) == 0, F.lit(k)) for k in EVIDENCE_KEYS])
    return gold.groupingSets([[k] for k in EVIDENCE_KEYS], *EVIDENCE_KEYS).agg(
        part.alias("part"), m["total"].alias("revenue"), m["sales"].alias("txns"), F.round(m["mean"], 2).alias("avg_ticket"))


def evidence_report(evidence: DataFrame, name: str, model: ProfitModel = DEFAULT_PROFIT_MODEL, n: int = 15) -> DataFrame:
    """One of the reports that ``evidence`` holds, as the operator of that name gives it."""
    of = lambda key: evidence.where(F.col("part") == key)
    label = month_label_of(F.col("txn_month_key")).alias("txn_month_label")
    if name in ("city_scorecard", "category_scorecard"):
        key = "city_id" if name == "city_scorecard" else "category"
        return of(key).select(key, "revenue", "txns", "avg_ticket").orderBy(F.desc("revenue"), key)
    if name == "monthly_seasonality":
        return of("txn_month_key").select("txn_month_key", label, "revenue", "txns").orderBy("txn_month_key")
    if name == "month_profile":
        return of("txn_month_key").select("txn_month_key", label, F.col("txns").alias("n")).orderBy("txn_month_key")
    if name == "hourly_curve":
        return of("txn_hour").select("txn_hour", "revenue", "txns").orderBy("txn_hour")
    if name == "category_profile":
        return of("category").select("category", F.col("txns").alias("n"), F.col("revenue").alias("total")).orderBy(F.desc("n"), "category")
    if name == "city_volume_topn":
        return of("city_id").select("city_id", F.col("txns").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("city_id")).limit(n)
    if name == "installment_profit":
        factor = profit_factor(F.col("installments"), model)
        return of("installments").select(
            "installments", "revenue", "txns", factor.alias("profit_factor"), F.round(factor * F.col("revenue"), 0).alias("expected_profit"),
            F.round(F.lit(float(model.margin)) * F.col("revenue"), 0).alias("cash_profit")).orderBy("installments")
    raise ValueError(f"no such report: {name}")
