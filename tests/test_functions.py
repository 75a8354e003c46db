"""Scalar features on inline edge cases (FIXTURES.md section 7)."""

import datetime

from pyspark.sql import functions as F

from lendwise.functions import features as fx


def test_grade_letter_edges(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (5.0,), (5.5,), (6.0,), (35.0,), (36.0,)], "g double")
    got = [r[0] for r in df.select(fx.grade_letter("g")).collect()]
    assert got == ["Unknown", "Unknown", "A", "A", "Unknown", "B", "G", "Unknown"]


def test_emp_length_parsers(spark):
    vals = ["10+ years", "< 1 year", "1 year", "7 years", " 3 Years ", "n/a", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    regex = [r[0] for r in df.select(fx.emp_length_regex("s")).collect()]
    exact = [r[0] for r in df.select(fx.emp_length_exact("s")).collect()]
    assert regex == [11.0, 0.0, 1.0, 7.0, 3.0, None, None]
    assert exact == [11, 0, 1, 7, 3, None, None]


def test_parse_date_and_terms(spark):
    df = spark.createDataFrame([("05 March 2019", " 36 months"), ("not a date", "term"), (None, None)],
                               "d string, t string")
    r = df.select(fx.parse_date("d").alias("d"), fx.digits_to_int("t").alias("t")).collect()
    assert r[0]["d"] == datetime.date(2019, 3, 5) and r[0]["t"] == 36
    assert r[1]["d"] is None and r[1]["t"] is None
    assert r[2]["d"] is None and r[2]["t"] is None


def test_installment_rate_zero_is_null(spark):
    df = spark.createDataFrame([(1000.0, 0.0, 36), (1000.0, 0.12, 12), (1000.0, None, 12)],
                               "p double, r double, n int")
    r = [x[0] for x in df.select(fx.monthly_installment("p", "r", "n")).collect()]
    assert r[0] is None and r[2] is None
    m = 0.01
    assert abs(r[1] - 1000 * m * (1 + m) ** 12 / ((1 + m) ** 12 - 1)) < 1e-9


def test_cap_keeps_null_and_is_idempotent(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    once = df.select(fx.cap("x", 0.0, 1.0).alias("x"))
    twice = once.select(fx.cap("x", 0.0, 1.0).alias("x"))
    assert [r[0] for r in once.collect()] == [None, 0.0, 0.5, 1.0]
    assert once.collect() == twice.collect()
    lower = [r[0] for r in df.select(fx.cap("x", lower=0.0)).collect()]
    assert lower == [None, 0.0, 0.5, 9.0]


def test_log_guards_and_scaling(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,)], "x double")
    r = df.select(fx.safe_ln("x").alias("a"), fx.safe_ln1p("x").alias("b")).collect()
    assert [x["a"] for x in r] == [None, None, 0.0]
    assert r[1]["b"] is None and r[0]["b"] == 0.0
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [x[0] for x in const.select(fx.minmax_scale("x", 3.0, 3.0)).collect()] == [0.0, 0.0]


def test_salary_and_tokens(spark):
    df = spark.createDataFrame([(10.0, 5.0, "Debt consolidation"), (None, 5.0, None)],
                               "i double, a double, d string")
    r = df.select(fx.salary_can_cover("i", "a").alias("s"), fx.standardise_text("d").alias("t"),
                  fx.first_token(fx.standardise_text("d"), "_").alias("f")).collect()
    assert (r[0]["s"], r[0]["t"], r[0]["f"]) == (1, "debt_consolidation", "debt")
    assert (r[1]["s"], r[1]["t"]) == (0, None)
