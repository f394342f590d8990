"""Association between two categorical columns, computed inside Spark.

``cramers_v`` needs no pivot and no driver round trip.  With cell counts
``o_ij``, row totals ``r_i``, column totals ``c_j``, ``N`` rows and
``e_ij = r_i · c_j / N``,

    χ² = Σ_observed (o_ij − e_ij)² / e_ij + Σ_never observed e_ij,
    V = √(χ² / N / min(r − 1, k − 1)).

Every term is positive, so nothing cancels however large ``N`` is.  The cells
that never occur are not listed: those of a row value together expect
``r_i · (N − Σ_observed c_j) / N``, a difference of exact integers.  Gold is
scanned once; the row and column totals are aggregates of the cells and reuse
their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long-form contingency table: (a, b, n) for every observed pair."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def cramers_v(df: DataFrame, a: str = "city_id", b: str = "category") -> DataFrame:
    """One row: n, r, k, chi2 (6 decimals), cramers_v (9 decimals).

    Rows with a NULL in either column are left out (a pivot drops NULL keys).
    ``r`` or ``k`` equal to 1 gives a NULL V.
    """
    return cramers_v_of_cells(contingency(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b), a, b)


def cramers_v_of_cells(cells: DataFrame, a: str, b: str) -> DataFrame:
    """:func:`cramers_v` of a contingency table (a, b, n) without NULL keys."""
    rows = cells.groupBy(a).agg(F.sum("n").alias("r_i"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("c_j"))
    whole = cols.select(F.struct(F.sum("c_j").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    total = F.col("whole.n")
    per_row = (
        cells.join(rows, on=a)
        .join(cols, on=b)
        .withColumn("whole", whole)
        .withColumn("e", F.col("r_i").cast("double") * F.col("c_j") / total)
        .groupBy(a)
        .agg(
            F.sum((F.col("n") - F.col("e")) * (F.col("n") - F.col("e")) / F.col("e")).alias("seen"),
            F.sum("c_j").alias("seen_c"),
            F.max("r_i").alias("r_i"),
            F.max("whole").alias("whole"),
        )
    )
    unseen = F.col("r_i").cast("double") * (total - F.col("seen_c")) / total
    out = per_row.agg(
        F.max(total).cast("double").alias("n"),
        F.coalesce(F.max("whole.k"), F.lit(0).cast("long")).alias("k"),
        F.count(F.lit(1)).alias("r"),
        (F.sum("seen") + F.sum(unseen)).alias("x2"),
    )
    dof = F.least(F.col("r") - 1, F.col("k") - 1).cast("double")
    v = F.sqrt(F.try_divide(F.col("x2"), F.col("n") * dof))
    return out.select("n", "r", "k", F.round("x2", 6).alias("chi2"), F.round(v, 9).alias("cramers_v"))


def category_mix_top_cities(gold: DataFrame, top: int = 6) -> DataFrame:
    """Category mix (n, city total t, pct) in the ``top`` busiest cities.

    The busiest cities are ranked by transaction count (ties: lowest id, NULL
    first); a NULL city may take a slot but matches no row, as an ``IN`` list
    would.  The top list (city, total) is at most ``top`` rows, so it is
    broadcast; the cell counts are aggregated once and feed both the ranking
    and the mix.
    """
    cells = contingency(gold, "city_id", "category")
    top_cities = (
        cells.groupBy("city_id")
        .agg(F.sum("n").cast("long").alias("t"))
        .orderBy(F.col("t").desc(), F.col("city_id").asc_nulls_first())
        .limit(top)
        .filter(F.col("city_id").isNotNull())
    )
    # The top list carries each city's total, so one join gives n and t.  The
    # join is null-safe on purpose: the list holds no NULL city, and a plain
    # equality would push an inferred `city_id IS NOT NULL` into this copy of
    # the cells, which then no longer matches the ranking's copy and is
    # recomputed instead of reusing its shuffle.
    top_b = F.broadcast(top_cities.withColumnRenamed("city_id", "top_city"))
    return (
        cells.join(top_b, cells.city_id.eqNullSafe(top_b.top_city))
        .withColumn("pct", F.round(F.lit(100.0) * F.col("n") / F.col("t"), 1))
        .orderBy("city_id", "category")
        .select("city_id", "category", "n", "t", "pct")
    )


def dominant_category_by_city(gold: DataFrame) -> DataFrame:
    """Each city's most frequent category, its count and its share (%).

    Ties go to the alphabetically first category.  Implemented as two
    aggregates (cells, then per city a sum and an arg-max), never a window
    over a city's rows.
    """
    cells = contingency(gold, "city_id", "category")
    # min over (-n, category) = most frequent, then first by name.
    best = F.struct((-F.col("n")).alias("neg_n"), F.col("category").alias("category"))
    per_city = cells.groupBy("city_id").agg(
        F.sum("n").cast("long").alias("t"), F.min(best).alias("best")
    )
    n = -F.col("best.neg_n")
    return per_city.select(
        "city_id",
        F.col("best.category").alias("category"),
        n.alias("n"),
        F.round(F.lit(100.0) * n / F.col("t"), 1).alias("pct"),
    ).orderBy("city_id")
