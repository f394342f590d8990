"""Column-expression builders: casts, timestamps, labels, money, profit model."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.functions import (
    DEFAULT_PROFIT_MODEL,
    ProfitModel,
    UNKNOWN_CATEGORY,
    clean_category,
    default_probability,
    hour_label,
    lenient_int,
    money_mean,
    money_parts,
    money_sum,
    money_value,
    month_label_of,
    parse_timestamp,
    profit_factor,
)
from ledgerlake.functions.money import money_off_grid

INT_CASES = [
    ("12", 12),
    (" 7 ", 7),
    ("+4", 4),
    ("-3", -3),
    ("12.0", 12),
    ("12.9", 12),
    ("-3.7", -3),
    ("5.", 5),
    (".5", 0),
    ("-.5", 0),
    (" .5 ", 0),
    (".", 0),
    ("..5", None),
    ("+", None),
    ("2147483647.9", 2147483647),
    ("", None),
    ("abc", None),
    ("inf", None),
    ("3000000000", None),
    (None, None),
]


@pytest.mark.parametrize("mode", [True, False])
def test_lenient_int_never_raises(spark, ansi, mode):
    ansi(mode)
    df = spark.createDataFrame([(s,) for s, _ in INT_CASES], "s string")
    got = [r[0] for r in df.select(lenient_int(F.col("s"))).collect()]
    assert got == [want for _, want in INT_CASES]


def test_lenient_int_equals_non_ansi_cast(spark, ansi):
    ansi(False)
    df = spark.createDataFrame([(s,) for s, _ in INT_CASES], "s string")
    rows = df.select(F.col("s").cast("int").alias("legacy"), lenient_int(F.col("s")).alias("ours")).collect()
    assert [r.ours for r in rows] == [r.legacy for r in rows]


@pytest.mark.parametrize("mode", [True, False])
def test_parse_timestamp_text(spark, ansi, mode):
    ansi(mode)
    rows = [("2017-10-05 08:07:00",), ("2017-10-01",), ("bad",), (None,), ("2017-02-30 10:00:00",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("s"), StringType())).collect()]
    assert got == [dt.datetime(2017, 10, 5, 8, 7), None, None, None, None]


EDGE_TEXTS = [
    "2017-10-01T13:30:00", " 2017-10-01 13:30:00", "2017-10-01 13:30:00 ", "2017-10-01 13:30:00.5",
    "2017-10-01 24:00:00", "2017-1-01 13:30:00", "-017-10-01 13:30:00", "+017-10-01 13:30:00",
    "2017-02-29 10:00:00", "2016-02-29 10:00:00", "2017-13-01 10:00:00", "2017-10-01 13:60:00",
    "2017-10-01 13:30:60", "abcd-ef-gh ij:kl:mn", "2017-10-01 1a:30:00", "2017/10/01 13:30:00",
    "20171-10-01 13:30:00", "2017-10-01 13:30", "9999-12-31 23:59:59", "0001-01-01 00:00:00",
    "2017-10-01 13:30:0 ", "2017-10-01  3:30:00", "2017-10-01 13:30:00\n", "\n2017-10-01 13:30:00",
]


def test_parse_timestamp_layout_check_equals_strict_parser(spark):
    """The fast layout check accepts exactly what the strict formatter accepts."""
    df = spark.createDataFrame([(s,) for s in EDGE_TEXTS], "s string")
    t = F.col("s")
    strict = F.when(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull(), t.try_cast("timestamp_ntz"))
    rows = df.select(
        "s",
        strict.cast("string").alias("strict"),
        parse_timestamp(t, StringType()).cast("string").alias("fast"),
    ).collect()
    assert [(r.s, r.fast) for r in rows] == [(r.s, r.strict) for r in rows]
    assert sum(r.fast is not None for r in rows) == 3


def test_parse_timestamp_ignores_session_zone(spark):
    """A wall clock inside a daylight-saving gap is kept as written."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2017-03-12 02:30:00",)], "s string")
        got = df.select(parse_timestamp(F.col("s"), StringType()).alias("t")).first().t
        assert got == dt.datetime(2017, 3, 12, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_timestamp_passes_timestamps_through(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    out = df.select(parse_timestamp(F.col("t"), df.schema["t"].dataType).alias("t"))
    assert out.first().t == dt.datetime(2017, 1, 2, 3, 4, 5)
    assert out.schema["t"].dataType.typeName() == "timestamp_ntz"


def test_parse_timestamp_accepts_session_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 2, 3, 4, 5),)], "t timestamp")
    out = df.select(parse_timestamp(F.col("t"), df.schema["t"].dataType).alias("t"))
    assert out.first().t == dt.datetime(2017, 1, 2, 3, 4, 5)  # UTC session
    assert out.schema["t"].dataType.typeName() == "timestamp_ntz"


def test_clean_category(spark):
    rows = [(None,), ("",), ("   ",), ("  A ",), ("B",), ("\t",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(clean_category(F.col("c"))).collect()]
    assert got == [UNKNOWN_CATEGORY, UNKNOWN_CATEGORY, UNKNOWN_CATEGORY, "A", "B", "\t"]


def test_hour_label(spark):
    df = spark.createDataFrame([(0,), (8,), (13,), (None,)], "h int")
    got = [r[0] for r in df.select(hour_label(F.col("h"))).collect()]
    assert got == ["0000", "0800", "1300", None]


def test_money_sum_is_exact_and_partition_independent(spark):
    vals = [0.1, 0.2, 0.3] * 1000 + [1e6 + 0.01]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(money_sum(F.col("x"))).first()[0]
    b = df.repartition(7).agg(money_sum(F.col("x"))).first()[0]
    assert a == b == 600.0 + 1e6 + 0.01


def test_money_sum_keeps_many_decimals_exact(spark):
    vals = [-0.70333127, 0.12345678, 1.00000001] * 500
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.repartition(5).agg(money_sum(F.col("x"))).first()[0]
    assert got == float(sum(Decimal(repr(v)) for v in vals))


def test_money_mean_ignores_null_and_keeps_empty_null(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", None), ("a", 20.0), ("b", None)], "k string, x double")
    got = dict(df.groupBy("k").agg(money_mean(F.col("x")).alias("m")).collect())
    assert got == {"a": 15.0, "b": None}


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("mode", [True, False])
@pytest.mark.parametrize("amounts, total, mean", [
    ([10.0, INF], INF, INF),
    ([INF, -INF], NAN, NAN),
    ([NAN, 2.0], NAN, NAN),
    ([1e-12] * 1000, 1e-9, 1e-12),
    ([1e30, 5.25], 1e30, 5e29),
    ([1e300, 1e300], 2e300, 1e300),
    ([None, 7.5], 7.5, 7.5),
    ([None, None], None, None),
    ([0.0, -0.0], 0.0, 0.0),
])
def test_no_amount_is_left_out(spark, ansi, mode, amounts, total, mean):
    ansi(mode)
    df = spark.createDataFrame([(v,) for v in amounts], "x double").repartition(3)
    row = df.agg(money_sum(F.col("x")).alias("s"), money_mean(F.col("x")).alias("m")).first()
    for got, want in ((row.s, total), (row.m, mean)):
        assert got is None and want is None or math.isnan(got) and math.isnan(want) or got == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("magnitude", [1, 10**4, 4 * 10**7])
@pytest.mark.parametrize("decimals", [0, 2, 8])
def test_range_in_which_sums_are_exact(spark, magnitude, decimals):
    rnd = random.Random(magnitude + decimals)
    texts = [f"{rnd.uniform(-magnitude, magnitude):.{decimals}f}" for _ in range(4000)]
    df = spark.createDataFrame([(float(t),) for t in texts], "x double")
    sums = {df.repartition(parts).agg(money_sum(F.col("x"))).first()[0] for parts in (1, 5, 13)}
    assert sums == {float(sum(map(Decimal, texts)))}
    assert df.agg(money_off_grid(F.col("x"))).first()[0] == 0


def test_very_large_totals_of_the_exact_part(spark):
    """Far beyond a BIGINT of hundred-millionths: 2^20 rows of 1.3e8 and their decimals."""
    df = spark.range(1 << 20).select(F.lit(134217727.75).alias("x"))
    assert df.agg(money_sum(F.col("x"))).first()[0] == 134217727.75 * (1 << 20)


def test_off_grid_amounts_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (INF,), (None,), (2.5,), (1e-12,), (2.0**27,), (NAN,)], "x double")
    assert df.agg(money_off_grid(F.col("x"))).first()[0] == 4


def test_parts_of_groups_add_up(spark):
    df = spark.createDataFrame([(i % 3, i / 8) for i in range(50)] + [(0, INF)], "g int, x double")
    per = df.groupBy("g").agg(*[c.alias(n) for n, c in money_parts(F.col("x")).items()])
    names = list(money_parts(F.col("x")))
    assert per.select(money_value({n: F.sum(n) for n in names})).first()[0] == INF
    finite = per.where("g > 0").select(money_value({n: F.sum(n) for n in names})).first()[0]
    assert finite == sum(i / 8 for i in range(50) if i % 3)


def test_month_label_of_a_key(spark):
    df = spark.createDataFrame([(201612,), (199901,), (None,)], "k int")
    assert [r[0] for r in df.select(month_label_of(F.col("k"))).collect()] == ["Dec 2016", "Jan 1999", None]


@pytest.mark.parametrize("text", ["\t12.0", " \n-3\r", "\x0b7.9\x0c", "\x1f4", "\u00a05", "\t", "1 2"])
def test_blanks_are_those_of_a_cast(spark, ansi, text):
    ansi(False)
    df = spark.createDataFrame([(text,)], "s string")
    plain = df.select(F.col("s").cast("int")).first()[0]
    ansi(True)
    assert df.select(lenient_int(F.col("s"))).first()[0] == plain


def _python_factor(n, model: ProfitModel):
    if n is None or n <= 1:
        return model.margin
    p = 1 - (1 - model.rate) ** n if model.compounding else model.rate
    return model.margin - model.loss * p


@pytest.mark.parametrize("model", [DEFAULT_PROFIT_MODEL, ProfitModel(compounding=False)])
def test_profit_factor_matches_the_model(spark, model):
    ns = [None, -1, 0, 1] + list(range(2, 61))
    df = spark.createDataFrame([(n,) for n in ns], "n int")
    got = [r[0] for r in df.select(profit_factor(F.col("n"), model)).collect()]
    for n, g in zip(ns, got):
        assert g == pytest.approx(_python_factor(n, model), abs=1e-12)


def test_published_profit_table(spark):
    """P(default) and factor for 1, 2, 3, 6, 12 installments (3 decimals)."""
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 6, 12)], "n int")
    rows = df.select(
        F.round(default_probability(F.col("n")), 3), F.round(profit_factor(F.col("n")), 3)
    ).collect()
    assert [tuple(r) for r in rows] == [
        (0.0, 0.25), (0.406, 0.047), (0.542, -0.021), (0.79, -0.145), (0.956, -0.228)
    ]
    flat = df.select(profit_factor(F.col("n"), ProfitModel(compounding=False))).collect()
    assert [r[0] for r in flat][1:] == [0.1355] * 4


def test_no_python_udf_in_expressions(spark):
    schema = StructType([StructField("n", StringType())])
    df = spark.createDataFrame([("2",)], schema).select(profit_factor(F.col("n").cast("int")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
