"""Imputation, outliers, encoding, profiling, joins on inline tables."""

import pytest
from pyspark.sql import functions as F

from lendwise.operators import encode as enc
from lendwise.operators import impute as imp
from lendwise.operators import outliers as out
from lendwise.operators import profile as prof
from lendwise.operators.joins import assign_aligned, dedupe_dim, join_fitted, map_values


def test_mode_ignores_null_and_breaks_ties_low(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("b",), ("a",), ("b",), ("a",)], "x string")
    assert imp.mode_value(df, "x") == "a"
    filled = imp.fill_mode(df, "x")
    assert filled.where(F.col("x").isNull()).count() == 0


def test_group_mean_and_group_mode_fill(spark):
    df = spark.createDataFrame([("s1", 1.0, "t1", "x"), ("s1", None, "t1", None), ("s1", 3.0, "t1", "x"),
                                ("s2", None, "t2", None), ("s2", 4.0, "t2", "y"), (None, None, "t3", None)],
                               "g string, r double, c string, e string")
    r = imp.fill_group_mean(df, "r", "g", "r2").orderBy("g", "r").collect()
    by = [(x["g"], x["r"], x["r2"]) for x in r]
    assert (None, None, None) in by          # null group: no mean
    assert ("s1", None, 2.0) in by and ("s2", None, 4.0) in by
    m = imp.fill_group_mode(df, "e", "c", fallback="z").collect()
    assert sorted((x["c"], x["e"]) for x in m) == sorted(
        [("t1", "x"), ("t1", "x"), ("t1", "x"), ("t2", "y"), ("t2", "y"), ("t3", "z")])
    assert df.count() == imp.fill_group_mean(df, "r", "g").count()


def test_qcut_raises_on_duplicate_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "x double")
    with pytest.raises(ValueError):
        out.qcut(df, "x", 3, ["a", "b", "c"], "bin")


def test_iqr_cap_bounds(spark):
    df = spark.createDataFrame([(float(x),) for x in list(range(20)) + [1000.0]], "x double")
    lo, hi = out.fit_iqr_caps(df, "x")
    capped = out.cap_iqr(df, "x", "y")
    mx = capped.agg(F.max("y")).collect()[0][0]
    assert mx == hi and capped.agg(F.min("y")).collect()[0][0] >= lo


def test_onehot_unseen_and_null_are_zero(spark):
    df = spark.createDataFrame([("rent",), ("own",), (None,), ("castle",)], "h string")
    cols = enc.onehot_columns("h", ["own", "rent"], "h")
    r = df.select(*cols).collect()
    assert [tuple(x) for x in r] == [(0, 1), (1, 0), (0, 0), (0, 0)]
    cats, rows = enc.fit_onehot(df.where(F.col("h") != "castle"), "h")
    assert cats == ["own", "rent"] and rows == [("h", "rent", "h_rent")]


def test_label_encode_golden_grades(spark):
    df = spark.createDataFrame([(g,) for g in "GFEDCBAABC"], "g string")
    encoded, lk = enc.label_encode(df, "g")
    assert {r["g"]: r["g_encoded"] for r in encoded.collect()} == {c: i for i, c in enumerate("ABCDEFG")}
    assert lk.count() == 7
    back = enc.encode_from_lookup(df, lk.withColumnRenamed("feature", "feature"), "g")
    assert {r["g"]: r["g_encoded"] for r in back.collect()} == {c: str(i) for i, c in enumerate("ABCDEFG")}


def test_minmax_range(spark):
    df = spark.createDataFrame([(float(x),) for x in [3, 7, 11]], "x double")
    s = enc.minmax_scale(df, enc.fit_minmax(df, ["x"]))
    assert [r[0] for r in s.collect()] == [0.0, 7.5, 15.0]


def test_profile_reports(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, None, None), (4, "b", 10.0)],
                               "k int, c string, v double")
    mp = {r["column"]: r["missing_pct"] for r in prof.missing_pct(df).collect()}
    assert mp == {"k": 0.0, "c": 25.0, "v": 25.0}
    assert [r["k"] for r in prof.duplicate_rows(df, "k").collect()] == [2]
    h = {r["bin"]: r["count"] for r in prof.histogram(df, "v", 3).collect()}
    assert h == {1: 2, 2: 0, 3: 1}                  # x = max lands in the last bin
    nc = {r["column"]: r["null_count"] for r in prof.null_counts(df, ["c", "v"]).collect()}
    assert nc == {"c": 1, "v": 1}
    bs = prof.box_stats(df, "v").collect()[0]
    assert bs["median"] == 1.0 and bs["n_outliers"] == 0 and bs["whisker_high"] == 10.0
    wide = spark.createDataFrame([(float(x),) for x in list(range(1, 11)) + [100.0]], "v double")
    bw = prof.box_stats(wide, "v").collect()[0]
    assert bw["n_outliers"] == 1 and bw["whisker_high"] == 10.0


def test_joins_keep_row_count(spark):
    big = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("x", "X1", 1), ("x", "X2", 2), ("y", "Y", 1)], "k string, name string, o int")
    d = dedupe_dim(dim, "k", "o", keep="last")
    m = map_values(big, d, "k", "k", "name", "name")
    assert sorted((r["id"], r["name"]) for r in m.collect()) == [(1, "X2"), (2, "Y"), (3, None)]
    with pytest.raises(ValueError):
        assign_aligned(big, dim, "k", ["name"])
    j = join_fitted(big, d.select("k", "name"), ["k"], "left")
    assert j.count() == 3
