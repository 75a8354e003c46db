"""Whole reports in few reads, one rule for NaN, duplicates by fingerprint."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.operators import profile
from lendwise.plans import analytics as an
from lendwise.plans import fused, reports

#: Mended by the report: the plain functions, one read (or more) each.
PLAIN = {
    "rate_nulls_by_status": lambda d: profile.null_count_by_group(d, "int_rate", "loan_status"),
    "joint_nulls_by_type": lambda d: profile.null_count_by_group(d, "annual_inc_joint", "type", with_mean=False),
    "distinct_values": lambda d: profile.distinct_values(d, reports.CATEGORIES),
    "schema": profile.schema_report, "null_counts": profile.null_counts, "missing_pct": profile.missing_pct,
    "zscore_outliers": lambda d: profile.zscore_outliers(d, reports.Z_COLUMNS), "histogram_income": lambda d: profile.histogram(d, "annual_inc", 30),
    "kde_income": lambda d: profile.kde(d, "annual_inc"), "box_amount": lambda d: profile.box_stats(d, "loan_amount"),
    "status_by_home_income": an.status_by_home_income, "loans_by_state": an.loans_by_state, "income_by_state_year": an.income_by_state_year,
    "top_income_state_per_year": an.top_income_state_per_year, "income_by_title": an.income_by_title, "income_amount_by_title_home": an.income_amount_by_title_home,
    "spread_income": lambda d: profile.spread_report(d, "annual_inc"), "first_token_match": lambda d: profile.first_token_match(d, "description", "purpose"),
}


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) if isinstance(a, float) and isinstance(b, float) else a == b


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    order = lambda r: [(x is not None, round(x, 6) if isinstance(x, float) else x) for x in r]
    a, b = (sorted((tuple(r) for r in x.select(*cols).collect()), key=order) for x in (a, b))
    assert len(a) == len(b) and all(close(x, y) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


@pytest.fixture(scope="module")
def holed(spark, sf):
    """Loans with nulls in keys and NaN in numbers."""
    df = loans(spark, sf)
    k = F.col("loan_id")
    return df.withColumns({"loan_status": F.when(k % 13 > 0, F.col("loan_status")), "annual_inc": F.when(k % 17 == 0, float("nan")).otherwise(F.col("annual_inc")),
                           "addr_state": F.when(k % 11 > 0, F.col("addr_state")), "issue_date": F.when(k % 19 > 0, F.col("issue_date"))})


@pytest.mark.parametrize("name", list(PLAIN))
def test_fused_reports_equal_the_plain_ones(spark, holed, name):
    from lendwise.schema import nan_to_null
    same(reports.eda_report(holed)[name], PLAIN[name](nan_to_null(holed)))


def test_a_report_reads_its_input_five_times(spark, sf, monkeypatch):
    """The passes, counted where they start; every table but the two made of rows comes from them."""
    runs = []
    for f in ("keyed_pass", "column_facts", "quantile_facts"):
        monkeypatch.setattr(fused, f, lambda *a, _f=getattr(fused, f), _n=f, **k: (runs.append(_n), _f(*a, **k))[1])
    rep = reports.eda_report(loans(spark, sf))
    for name in rep:
        df = rep[name]
        if name not in ("duplicates", "emp_title_missing"):
            assert "o_orderkey" not in df._jdf.queryExecution().optimizedPlan().toString(), name
    assert sorted(runs) == ["column_facts", "keyed_pass", "keyed_pass", "quantile_facts"]  # the last is two reads


def test_dashboard_reads(spark, sf):
    df = loans(spark, sf).withColumn("grade_category", F.lit("A"))
    d = reports.dashboard_tables(df, grade="grade_category")
    for name in ("grade_share", "loans_per_month", "year_options", "top5_states"):
        assert "o_orderkey" not in d[name]._jdf.queryExecution().optimizedPlan().toString()
    same(d["top5_states"], an.top_states_by_amount(df, 5))
    same(d["loans_per_month"], an.loans_per_month(df))
    same(d["year_options"], an.year_options(df))


def test_reports_of_an_empty_table(spark, sf):
    rep = reports.eda_report(loans(spark, sf).where("loan_id < 0"))
    assert {n: rep[n].count() for n in ("summary", "box_amount", "kde_income", "histogram_income", "loans_by_state")} == {
        "summary": 9, "box_amount": 0, "kde_income": 0, "histogram_income": 30, "loans_by_state": 0}


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "a"), (2.0, "b"), (None, "b")], "x double, g string")
    s = profile.numeric_summary(df, ["x"]).first()
    assert (s["count"], s["mean"], s["max"], s["q50"]) == (2, 1.5, 2.0, 1.5) and math.isclose(s["std"], math.sqrt(0.5))
    assert tuple(profile.min_max(df, ["x"]).first())[1:] == (1.0, 2.0)
    assert tuple(profile.spread_report(df, "x").first())[1:] == (1.25, 1.75, 0.5, 1.0, 2.0)
    assert profile.box_stats(df, "x").first()["n_outliers"] == 0
    assert profile.missing_pct(df, ["x"]).first()["missing_pct"] == 50.0 and profile.null_counts(df, ["x"]).first()["null_count"] == 2
    assert profile.kde(df, "x").count() == 64 and {r["missing_values"] for r in profile.null_count_by_group(df, "x", "g").collect()} == {1}


def test_duplicates_by_fingerprint(spark):
    rows = [(k, (k % 7 or None), None if k % 5 == 0 else "v", float(k % 3)) for k in range(500)] + [(900, None, "v", 0.5), (901, 1, None, 0.5), (902, None, "v", 0.5)]
    df = spark.createDataFrame(rows, "k int, a int, b string, c double").repartition(4)
    seen, want = {}, []
    for k, *rest in sorted(rows):
        want += [k] if tuple(rest) in seen else []
        seen.setdefault(tuple(rest), k)
    assert sorted(r["k"] for r in profile.duplicate_rows(df, "k").collect()) == want
    assert profile.duplicate_rows(df, "k").columns == df.columns
    plan = profile.duplicate_rows(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_duplicates_of_many_computed_columns_are_planned_on_a_plain_table(spark, monkeypatch):
    """The optimizer's constraints grew with every computed column where the first rows were too many to broadcast."""
    from lendwise.operators import joins

    base = spark.range(400).select("id", *[(F.col("id") % 50 + i).alias(f"x{i}") for i in range(6)])
    wide = base.select("id", *[F.when(F.col(f"x{i % 6}") % (i + 2) == 0, F.col(f"x{i % 6}")).alias(f"c{i}") for i in range(12)])
    wide = wide.unionByName(wide.where("c0 > 10").withColumn("id", F.col("id") + 1_000))
    rows, small, seen, want = wide.collect(), joins.join_fitted, {}, []
    for r in sorted(rows):
        want += [r["id"]] if tuple(r)[1:] in seen else []
        seen.setdefault(tuple(r)[1:], r["id"])
    monkeypatch.setattr(profile, "join_fitted", lambda big, fit, on: small(big, fit, on, max_rows=5))
    got = profile.duplicate_rows(wide, "id")
    plan = got._jdf.queryExecution().optimizedPlan()
    assert "CASE WHEN" not in plan.toString() and sorted(r["id"] for r in got.collect()) == want
    assert got.columns == wide.columns


def test_density_of_a_heavy_tail(spark):
    x = np.concatenate([np.random.default_rng(5).lognormal(0, 1.5, 4_000), [900.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = x.std(ddof=1) * len(x) ** -0.2
    got = sorted(profile.kde(df, "x", 50).collect())
    want = [np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for r in got]
    assert len(got) == 50 and max(abs(r["density"] - w) for r, w in zip(got, want)) < 1e-3 * max(want)


def test_sums_are_made_only_for_the_reports_that_need_them(spark):
    """A value beyond the money type counts in reports without sums, and outside the rows that a report sums."""
    df = spark.createDataFrame([("a", 1.25, 1), ("a", 1e30, 2), ("b", 2.5, 1), (None, None, 1), ("a", 0.25, 1)], "g string, x double, k int")
    t = fused.keyed_pass(df, [fused.Keyed("most", ("g",), x="x"), fused.Keyed("all", (), x="x", y="k"),
                              fused.Keyed("sum", ("g", "k"), x="x", where="k = 1 AND g IS NOT NULL", sums="x")])
    assert {tuple(r) for r in t.of("most", {"g": "STRING"}, n="n", m="x_max").collect()} == {("a", 3, 1e30), ("b", 1, 2.5), (None, 1, None)}
    assert [tuple(r) for r in t.of("all", n="n", x="x_n", y="y_n").collect()] == [(5, 4, 5)]
    assert {tuple(r) for r in t.of("sum", {"g": "STRING", "k": "INT"}, s="x_sum").collect()} == {("a", 1, 1.5), ("b", 1, 2.5)}
    with pytest.raises(ValueError):
        t.of("most", {"g": "STRING"}, s="x_sum")
