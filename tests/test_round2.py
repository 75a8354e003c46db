"""Hot values, many buckets, null groups, plain means, empty bins, all-null columns, incomplete outputs."""

import math
import os
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.operators import encode, impute, joins, ordered, outliers, profile
from lendwise.plans import analytics as an
from lendwise.session import checkpoint_dir
from lendwise.sources import files
from lendwise.streaming import stream

PROBS = [0.0, 0.05, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


def skewed(n, seed=1):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), 42.0 if r.random() < 0.35 else r.choice([None, float("nan"), r.gauss(0, 100), r.gauss(0, 100)]))
            for _ in range(n)]


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_exact_quantiles_with_a_hot_value(spark, accuracy):
    rows = skewed(20_000)
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    for group in ([], ["g"]):
        got = {(r["g"] if group else "", round(r["prob"], 9)): r["value"]
               for r in ordered.exact_quantiles(df, "x", PROBS, group, accuracy).collect()}
        for g in {r[0] for r in rows} if group else {""}:
            x = [v for k, v in rows if v is not None and not math.isnan(v) and (not group or k == g)]
            for p in PROBS:
                assert math.isclose(got[(g, round(p, 9))], np.quantile(x, p), rel_tol=1e-12, abs_tol=1e-12)


def test_quantiles_shuffle_counts_not_rows(spark):
    df = spark.createDataFrame([(42.0,)] * 3_000 + [(float(i),) for i in range(6_000)], "x double").repartition(4)
    q = ordered.exact_quantiles(df, "x", [0.5], accuracy=1_000)
    assert q.collect()[0]["value"] == np.quantile([42.0] * 3_000 + list(range(6_000)), 0.5)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "partial_count" in plan


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)] * 3, "x double")
    assert ordered.exact_quantiles(df, "x", [0.5]).count() == 0
    assert outliers.fit_iqr_caps(df, "x") == (None, None)
    assert [r["x"] for r in outliers.cap_iqr(df, "x").collect()] == [None] * 3


def test_many_buckets(spark):
    keys = [(i % 5, float(i * 7 % 5_003)) for i in range(5_000)] + [(None, 1.0), (2, None)]
    df = spark.createDataFrame(keys, "g int, x double").repartition(3)
    bounds = ordered.bucket_bounds(df, ["g", "x"], 1_200)
    assert len(bounds) > 1_000
    by = df.select("g", "x", ordered.bucket_expr(df, ["g", "x"], bounds).alias("b")).collect()
    order = lambda t: [(v is not None, v or 0) for v in t]
    for r in by[::7]:
        assert r["b"] == sum(order(b) <= order((r["g"], r["x"])) for b in bounds)


def test_lag_with_null_groups_and_many_buckets(spark):
    r = random.Random(3)
    rows = [(i, r.choice([None, "p", "q"]), r.choice([None, 1, 2]), r.randrange(50)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "id int, g string, k int, o int").repartition(4)
    got = ordered.ordered_lag(df, ["g", "k"], ["o", "id"], {"id": "before"}, buckets=400).collect()
    want = df.withColumn("before", F.lag("id").over(Window.partitionBy("g", "k").orderBy("o", "id"))).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_lag_shuffles_full_rows_once(spark, sf):
    df = an.previous_by_grade(an.notebook_prepare(loans(spark, sf)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning(_lw_bucket" in x]
    # The rows' exchange and its reuse for the tail table; the rest of the tail's exchanges lie above a window.
    assert len({x.split("hashpartitioning")[1].split("#")[0] for x in wide}) == 1


def test_fill_by_two_keys_skips_null_groups(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, None), ("a", "x", 3.0), ("a", "x", None)], "g string, h string, v double")
    got = sorted(str(r["v"]) for r in impute.fill_group_mean(df, "v", ["g", "h"]).collect())
    assert got == sorted(["1.0", "None", "3.0", "3.0"])


def test_fitted_joins_do_not_shuffle_rows(spark, sf):
    df = loans(spark, sf)
    base = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    for out in (impute.fill_group_mean(df, "int_rate", "loan_status"), impute.fill_group_mode(df, "emp_title", "loan_status")):
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == base
    small = spark.createDataFrame([(i, i) for i in range(30)], "k int, v int")
    big = spark.createDataFrame([(1,), (None,), (29,)], "k int")
    assert sorted(str(r["v"]) for r in joins.join_fitted(big, small, "k", "left", max_rows=5).collect()) == ["1", "29", "None"]


def test_rates_are_not_rounded(spark):
    df = spark.createDataFrame([("Default", 1.0, 10.0, 0.12345678, 1), ("Default", 1.0, 10.0, 0.12344321, 1)],
                               "loan_status string, annual_inc double, loan_amount double, int_rate double, emp_length int")
    assert math.isclose(an.default_by_income(df).collect()[0]["avg_interest_rate"], 0.123449995, rel_tol=1e-12)
    tiny = spark.createDataFrame([(1e-9,), (3e-9,)], "x double")
    assert math.isclose(profile.numeric_summary(tiny, ["x"]).collect()[0]["mean"], 2e-9)


def test_density_close_to_brute_force(spark):
    x = np.concatenate([np.random.default_rng(1).normal(0, 1, 3_000), np.random.default_rng(2).normal(40, 3, 1_000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = x.std(ddof=1) * len(x) ** -0.2
    got = sorted(profile.kde(df, "x", 40).collect())
    want = [np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for r in got]
    assert len(got) == 40 and max(abs(r["density"] - w) for r, w in zip(got, want)) < 1e-3 * max(want)
    assert profile.kde(spark.createDataFrame([(5.0,)] * 4, "x double"), "x").count() == 0


def test_histogram_has_empty_bins_and_ignores_nan(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (float("nan"),), (None,)], "x double")
    assert [(r["bin"], r["count"]) for r in sorted(profile.histogram(df, "x", 5).collect())] == [(1, 2), (2, 0), (3, 0), (4, 0), (5, 1)]


def test_declared_text_dates(spark, sf):
    df = loans(spark, sf)
    text = df.withColumn("issue_date", F.date_format("issue_date", "dd MMMM yyyy"))
    for f in (an.income_by_state_year, an.income_by_year_bucket, an.loans_per_month, an.year_options):
        assert sorted(map(str, f(df).collect())) == sorted(map(str, f(text).collect()))


def test_last_stored_lookup_row_by_sequence(spark):
    lookup = spark.createDataFrame([("f", "a", "9", 1), ("f", "a", "0", 2), ("f", "b", "1", 3)],
                                   "feature string, original_value string, encoded_value string, seq int").repartition(3)
    assert {r["f"]: r["code"] for r in encode.lookup_codes(lookup, "f", "f").collect()} == {"a": "0", "b": "1"}


def test_incomplete_output_is_computed_again(spark, tmp_path):
    path = str(tmp_path / "out")
    one = lambda: spark.range(3)
    assert files.cached_or_compute(spark, path, one).count() == 3
    os.remove(f"{path}/_SUCCESS")
    assert files.cached_or_compute(spark, path, lambda: spark.range(5)).count() == 5
    assert files.cached_or_compute(spark, path, one).count() == 5


def test_malformed_message_is_a_dead_letter(spark):
    schema = stream.message_schema()
    rows = ['{"loan_id": 7}', '"EOF"', "{not json", '{"loan_id": "x"}', "[1]", "5", "  ", '{"loan_id": 8, "other": 1}']
    got = stream.decode(spark.createDataFrame([(v,) for v in rows], "value string"), schema).collect()
    assert sorted(str(r["loan_id"]) for r in got if not r["_dead"]) == ["7", "8", "None"]
    assert sorted(r["_dead"]["value"] for r in got if r["_dead"]) == sorted(["{not json", '{"loan_id": "x"}', "[1]", "5"])
    assert all(r["loan_id"] is None for r in got if r["_dead"])


def test_a_cluster_without_a_shared_folder_is_an_error():
    conf = SimpleNamespace(get=lambda *_: None, set=lambda *_: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
