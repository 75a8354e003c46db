"""Quantiles by distributed selection: a fixed number of candidates per rank, whatever the input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendwise.operators import joins, ordered

PROBS = [0.95, 0.0, 0.05, 0.25, 1 / 3, 0.5, 0.5, 0.75, 0.999, 1.0]


def left_over(df, probs, candidates):
    """(most counted values per rank, narrowing passes) of one selection."""
    ps = sorted(set(probs))
    d = df.select(F.col("x").alias("_x"))
    brackets, narrowings = ordered._brackets(d, [], ps, ordered.ACCURACY, candidates)
    for _ in range(narrowings):
        brackets, _ = ordered._held(ordered._narrowed(d, brackets, [], ps, ordered.ACCURACY))
    r = ordered._counted(d, brackets, [], len(ps)).first()
    return max(len(r[f"_v{i}"]) for i in range(len(ps))), narrowings


@pytest.mark.parametrize("n", [100_000, 1_000_000])
def test_candidates_are_bounded_at_any_size(spark, n, tmp_path):
    spark.range(n, numPartitions=4).select((F.randn(3) * 1e4).alias("x")).write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    left, narrowings = left_over(df, PROBS, 400)
    assert left <= 400 and narrowings == 1  # without it about 16 rows in a thousand would be left
    x = df.toPandas()["x"].to_numpy()
    got = ordered.exact_quantiles(df, "x", PROBS, candidates=400).collect()
    assert [r["prob"] for r in got] == PROBS
    assert all(math.isclose(r["value"], np.quantile(x, r["prob"]), rel_tol=1e-12) for r in got)


@pytest.mark.parametrize(("accuracy", "candidates"), [(100, 50), (10_000, 60), (10_000, 5_000), (1_000, 100_000)])
def test_groups_hot_values_and_narrowing(spark, accuracy, candidates):
    r = random.Random(9)
    rows = [(r.choice(["a", "a", "a", "b", None]), 42.0 if r.random() < 0.4 else r.choice([None, float("nan"), float(r.randrange(3)), r.gauss(0, 100), r.expovariate(1) ** 9]))
            for _ in range(30_000)] + [("one", 5.0), ("two", 5.0), ("two", 7.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {(q["g"], q["prob"]): q["value"] for q in ordered.exact_quantiles(df, "x", PROBS, ["g"], accuracy, candidates).collect()}
    for g in {g for g, _ in rows} - {"none"}:
        x = [v for k, v in rows if k == g and v is not None and not math.isnan(v)]
        for p in PROBS:
            assert math.isclose(got[g, p], np.quantile(x, p), rel_tol=1e-12, abs_tol=1e-12), (g, p)
    assert not any(g == "none" for g, _ in got)


def test_many_groups_go_through_a_written_table(spark, monkeypatch):
    monkeypatch.setattr(joins, "FITTED_ROWS", 5)
    df = spark.range(4_000).select((F.col("id") % 40).alias("g"), (F.col("id") * 7919 % 4_001).cast("double").alias("x"))
    got = {r["g"]: r["value"] for r in ordered.exact_quantiles(df, "x", [0.3], "g", candidates=40).collect()}
    by = {}
    for r in df.collect():
        by.setdefault(r["g"], []).append(r["x"])
    assert got == {g: pytest.approx(np.quantile(x, 0.3)) for g, x in by.items()}


def test_no_window_and_no_order_of_rows(spark):
    df = spark.range(50_000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x"))
    plan = ordered.exact_quantiles(df, "x", [0.5, 0.9], "g", candidates=100)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan and "partial_count" in plan


def test_a_rank_outside_its_bracket_is_an_error(spark):
    pairs = spark.createDataFrame([([(1.0, 2), (3.0, 1)], 4)], "v array<struct<v:double,c:bigint>>, below bigint")
    at = lambda k: pairs.select(F.expr(ordered._at_rank("v", "below", f"{k}L")).alias("x"))
    assert [at(k).first()["x"] for k in (4, 5, 6)] == [1.0, 1.0, 3.0]
    for k in (3, 7):
        with pytest.raises(Exception, match="outside its bracket"):
            at(k).collect()
