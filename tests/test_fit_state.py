"""Fits as parts that merge."""

import pytest
from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.plans.fit_state import FitState
from lendwise.plans.pipeline import ETL_CONFIG, LoanPrep, LoanPrepConfig, fit_columns


@pytest.mark.parametrize("config", [LoanPrepConfig(), ETL_CONFIG], ids=["packaged", "etl"])
def test_fit_of_parts_is_the_fit_of_all(spark, sf, config):
    df = loans(spark, sf)
    whole = LoanPrep(config).fit(df)
    state, prep = FitState(spark), LoanPrep(config)
    for k in range(3):
        last = prep.fit(df.filter(F.col("loan_id") % 3 == k), state, part=f"day{k}")
    assert last.params == whole.params and state.parts() == ["day0", "day1", "day2"]
    assert prep.fit(df.filter("loan_id % 3 = 1"), state, part="day1").params == whole.params  # the same part again


def test_a_fit_keeps_nothing_on_executors(spark, sf):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    LoanPrep().fit(loans(spark, sf))
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    assert "InMemoryTableScan" not in fit_columns(loans(spark, sf))._jdf.queryExecution().executedPlan().toString()


def test_an_incomplete_part_does_not_count(spark, sf):
    df, state = fit_columns(loans(spark, sf)), FitState(spark)
    with pytest.raises(ValueError, match="nothing was added"):
        state.params(LoanPrepConfig())
    state.add(df.filter("loan_amount > 1000"), "a")
    want = state.params(LoanPrepConfig())
    df.limit(3).select("annual_inc", "annual_inc_joint", "avg_cur_bal", "tot_cur_bal", "emp_title").write.parquet(f"{state.base}/numbers/b")  # its mark is missing
    assert state.parts() == ["a"] and state.params(LoanPrepConfig()) == want
    with pytest.raises(ValueError, match="part's name"):
        state.add(df, "../a")


def test_title_after_the_fill(spark, sf):
    """The mode after the group fill, against counting the filled column."""
    rows = [(float(i), t) for i, t in enumerate("aab" + "bcc" * 2 + "ddd")] + [(float(i), None) for i in (0, 1, 7, 8, 8, 8)] + [(None, "z")] * 4
    part = loans(spark, sf).limit(1).drop("annual_inc", "emp_title")
    extra = spark.createDataFrame(rows, "annual_inc double, emp_title string")
    df = fit_columns(part.join(extra))  # one row on the left
    p = LoanPrep().model(FitState(spark).add(df)).params
    label = lambda x: None if x is None else "q1" if x <= p["income_terciles"][0] else "q2" if x <= p["income_terciles"][1] else "q3"
    filled = [t or p["emp_title_group_modes"].get(label(x)) for x, t in rows]
    filled = [t for t in filled if t]
    assert p["emp_title_mode"] == min(set(filled), key=lambda t: (-filled.count(t), t))


def test_too_many_categories_are_an_error(spark, sf):
    with pytest.raises(ValueError, match="more than 3 distinct values"):
        LoanPrep(LoanPrepConfig(max_categories=3)).fit(loans(spark, sf))
