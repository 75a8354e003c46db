"""Physical-plan properties the design relies on."""

import re

from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.plans import analytics as an
from lendwise.plans.pipeline import LoanPrep


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scan_reads_only_needed_columns(spark, sf):
    txt = _formatted(an.avg_gap_by_grade(loans(spark, sf)))
    orders_schema = [line for line in txt.splitlines()
                     if line.startswith("ReadSchema") and "o_orderkey" in line][0]
    for unused in ("o_orderdate", "o_orderpriority", "o_orderstatus"):
        assert unused not in orders_schema


def test_lag_never_partitions_by_grade_alone(spark, sf):
    df = an.day_gap_by_grade(an.previous_by_grade(an.notebook_prepare(loans(spark, sf))))
    df.collect()
    plan = _plan(df)
    # The row-level window is keyed by (bucket, grade); a grade-only exchange
    # may appear only over the tail table (at most buckets + groups rows).
    assert re.search(r"hashpartitioning\(_lw_bucket#\d+, _lw_g0#\d+L?, _lw_n0#\d+, \d+\)", plan)


def test_transform_adds_no_shuffle(spark, sf):
    df = loans(spark, sf)
    model = LoanPrep().fit(df)
    base = _plan(df).count("Exchange")
    assert _plan(model.transform(df)).count("Exchange") == base


def test_transform_is_stream_compatible(spark, sf):
    df = loans(spark, sf)
    model = LoanPrep().fit(df)
    # A rate source shaped like the loan schema: the transform must analyse as
    # a streaming plan (projections only, no unsupported operators).
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    shaped = rate.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    out = model.transform(shaped)
    assert out.isStreaming
    assert set(model.transform(df).columns) == set(out.columns)
