"""Operator 8: quality rules whose cutoffs are certified on labelled holdouts.

Every rule compares one measure of a text with a cutoff.  For each stratum the
cutoffs of a rule are tried from the loosest to the strictest; a cutoff is
certified if the exact binomial tail says that, at the error level left after
the correction for all strata and rules, so few rejected good documents would
be improbable if the true rate of false rejection were above the rule's share
of ``risk``.  The first that fails ends the sequence (so no further correction
is due within it).  Of the certified cutoffs the one that best tells the
labelled bad from the good holds, the loosest among equals; where none helps,
the rule is off.  With confidence 1 - ``error``, in no stratum are more than
``risk`` of the good documents rejected by the rules together.

Everything is DataFrame functions.  Measures are computed per row, counts of
labelled rows are pre-aggregated per stratum, rule and step of the cutoffs, so
a stratum with a third of all rows is a few numbers per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

RISK = 0.02
ERROR = 0.05
WORD_SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"

# Rules: measure, and cutoffs from strict to loose; a text above the cutoff is rejected.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5)),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45)),
    "lines": ("n_dup_lines / nullif(n_lines, 0)", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7)),
    "long_words": ("word_chars / nullif(n_words, 0)", (7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 12.0, 16.0, 24.0)),
    "short_words": ("-(word_chars / nullif(n_words, 0))", (-5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0, -1.5, -1.2)),
}

# Windows found twice or more, up to which they are looked up one by one.
_FEW = 64
_TERMS = 4096


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = None,
             carry: Column | None = None) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines).

    Whole texts; null text: all zero.  A null stratum is a stratum of its own.
    ``carry``: one more column, passed through as ``carry``.
    """
    extra = [] if carry is None else [carry.alias("carry")]
    more = [] if carry is None else ["carry"]
    stratum = docs[stratum_col].cast("string") if stratum_col else F.lit(None).cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), stratum.alias("stratum"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), *extra)
    rows = rows.withColumn("parts", F.split("text", WORD_SPACE)).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "doc_id", "stratum",
        (F.length("text") - F.size("parts") + 1).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array_remove("parts", "").alias("words"), *more)
    few = F.size("words") < 3
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    rows = rows.withColumn("windows", F.when(few, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)))
    rows = rows.withColumn("n_words", F.size("words").cast("long")).drop("words")
    rows = rows.withColumn("sorted", F.sort_array("windows"))
    rows = rows.withColumn("twice", F.filter("sorted", lambda x, i: (i > 0) & (x == F.get("sorted", i - 1)))).drop("sorted")
    rows = rows.withColumn("twice", F.array_distinct("twice"))
    # Few: each window is looked up among them.  Many: windows sorted with their places, equal neighbours.
    pairs = F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(F.size("twice") > _FEW, pairs))
    same = lambda s, i: ((i > 0) & (s["w"] == F.get("ordered", i - 1)["w"])) | (
        (i < F.size("ordered") - 1) & (s["w"] == F.get("ordered", i + 1)["w"]))
    places = F.sequence(F.lit(0), F.size("windows") - 1)
    rows = rows.withColumn("at", F.when(F.size("twice") == 0, F.array().cast("array<int>"))
                           .when(F.size("twice") <= _FEW, F.filter(places, lambda i: F.array_contains("twice", F.get("windows", i))))
                           .otherwise(F.sort_array(F.transform(F.filter("ordered", same), lambda s: s["i"]))))
    covered = F.expr("""aggregate(at, named_struct('n', 0, 'upto', 0),
        (a, i) -> named_struct('n', a.n + i + 3 - greatest(i, a.upto), 'upto', i + 3), a -> a.n)""")
    return rows.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       covered.cast("long").alias("n_repeat_words"), "n_lines", *more)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1: Stirling's series, eight steps up."""
    z = x + 8
    steps = F.ln(x)
    for k in range(1, 8):
        steps = steps + F.ln(x + k)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.ln(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - steps


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(at most ``k`` of ``n``) at rate ``p``: largest term first, then falling ones.

    Beyond the terms that are summed, the rest is bounded by a geometric
    series, so the value is never too small.  1 where k is not below n * p.
    """
    n, k = n.cast("double"), k.cast("double")
    first = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p
    terms = F.least(k, F.lit(float(_TERMS))).cast("int")
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(a: Column, t: Column) -> Column:
        term = a["term"] * (k - t) * odds / (n - k + t + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    steps = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, state, add)
    ratio = (k - terms) * odds / (n - k + terms + 1)
    rest = F.when(k > terms, total["term"] * ratio / (1 - ratio)).otherwise(0.0)
    return F.when((n > 0) & (k < n * p), F.least(F.lit(1.0), F.exp(first) * (total["sum"] + rest))).otherwise(1.0)


def certified_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
                      rules: dict = RULES) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_bad, good_rejected, bad_rejected): the cutoffs that hold.

    ``labels`` has (doc_id, good boolean); rows without a label or id are left
    out, a document labelled more than once counts as good if any label says so.
    """
    known = labels.where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"))
    rated = measured.where(~base_failed()).join(known, "doc_id")
    steps = F.array(*[
        F.struct(F.lit(name).alias("rule"),
                 sum((F.coalesce(F.expr(measure) > cutoff, F.lit(False)).cast("int") for cutoff in cutoffs), F.lit(0)).alias("step"))
        for name, (measure, cutoffs) in rules.items()])
    counts = rated.select("stratum", "good", F.explode(steps).alias("s")).groupBy("stratum", F.col("s.rule"), F.col("s.step")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # A row per cutoff: what lies above it.
    longest = max(len(c) for _, c in rules.values())
    spread = counts.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))))
    tried = spread.groupBy("stratum", "rule", "k").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
        F.sum(F.expr("if(step > k, good, 0)")).alias("good_rejected"), F.sum(F.expr("if(step > k, bad, 0)")).alias("bad_rejected"))
    grid = F.create_map(*[x for name, (_, cutoffs) in rules.items() for x in (F.lit(name), F.array(*map(F.lit, cutoffs)))])
    tried = tried.withColumn("cutoff", F.get(grid[F.col("rule")], F.col("k"))).where("cutoff IS NOT NULL")
    families = tried.select("stratum", "rule").distinct().select(F.count("*").alias("families"))
    tried = tried.withColumn("families", families.scalar())
    tail = binomial_tail(F.col("n_good"), F.col("good_rejected"), risk / len(rules))
    tried = tried.withColumn("holds", tail <= error / F.col("families"))
    # The strictest cutoff that fails ends the sequence for all stricter ones.
    ends = tried.groupBy("stratum", "rule").agg(F.max(F.when(~F.col("holds"), F.col("k"))).alias("failed"))
    fit = tried.join(ends.select(F.col("stratum").alias("s2"), F.col("rule").alias("r2"), "failed"),
                     F.col("stratum").eqNullSafe(F.col("s2")) & (F.col("rule") == F.col("r2")))
    fit = fit.where("k > coalesce(failed, -1)")
    value = F.col("bad_rejected") / F.greatest("n_bad", F.lit(1)) - F.col("good_rejected") / F.greatest("n_good", F.lit(1))
    best = fit.withColumn("value", value).where("value > 0").groupBy("stratum", "rule").agg(
        F.max(F.struct("value", "k", "cutoff", "n_good", "n_bad", "good_rejected", "bad_rejected")).alias("b"))
    return best.select("stratum", "rule", "b.cutoff", "b.n_good", "b.n_bad", "b.good_rejected", "b.bad_rejected")


def wide_cutoffs(cutoffs: DataFrame, rules: dict = RULES) -> DataFrame:
    """A row per stratum (``of``), a column per rule; null where the rule is off."""
    return cutoffs.groupBy(F.col("stratum").alias("of")).agg(
        *[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in rules])


def verdict(rules: dict = RULES) -> Column:
    """Whether a row of measures, joined with its stratum's cutoffs, stays."""
    rejected = base_failed()
    for name, (measure, _) in rules.items():
        rejected = rejected | F.coalesce(F.expr(measure) > F.col(f"cut_{name}"), F.lit(False))
    return ~rejected


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str | None = "lang", risk: float = RISK, error: float = ERROR, rules: dict = RULES) -> DataFrame:
    """One row per row of ``docs``: measures, ``base_failed`` and ``kept``.

    ``labels``: (doc_id, good boolean).  Null text: all measures zero, so the
    base fails.  Null ids and repeated rows: judged like any row.  Without
    labels (or too few to certify anything) only the base rejects.  Empty
    table: no rows.  Other columns are not read.
    """
    rated = written(measures(docs, id_col, text_col, stratum_col), "measures")
    cutoffs = certified_cutoffs(rated, labels, risk, error, rules)
    joined = rated.join(wide_cutoffs(cutoffs, rules), F.col("stratum").eqNullSafe(F.col("of")), "left")
    return joined.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), quality_labels(spark, sf_dir)).drop("stratum")
