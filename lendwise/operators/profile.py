"""Profiling and data-quality reports (Q1-Q16).

Reports over many columns are single aggregates (or one unpivot + one
grouped aggregate) rather than one job per column. Results are small tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.functions import features as fx
from lendwise.operators import ordered
from lendwise.operators.joins import join_fitted
from lendwise.schema import nan_to_null
from lendwise.sources.files import scratch_path


# One rule for NaN: it is missing, as null is, in every report here (``nan_to_null``).


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    return [xs] if isinstance(xs, str) else list(xs)


def _transpose(row_df: DataFrame, names: Sequence[str], fields: Sequence[str],
               name_col: str = "column") -> DataFrame:
    """One-row aggregate with columns ``{name}__{field}`` -> one row per name."""
    structs = [F.struct(F.lit(n).alias(name_col),
                        *[F.col(f"`{n}__{f}`").alias(f) for f in fields]) for n in names]
    return row_df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q1: percent of nulls per column, one aggregate for all columns."""
    cols, df = _cols(columns) or df.columns, nan_to_null(df)
    agg = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"{c}__missing_pct") for c in cols])
    return _transpose(agg, cols, ["missing_pct"])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q15: null count per column (0 everywhere after imputation)."""
    cols, df = _cols(columns) or df.columns, nan_to_null(df)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__null_count") for c in cols])
    return _transpose(agg, cols, ["null_count"])


def null_count_by_group(df: DataFrame, value: str, group: Sequence[str] | str,
                        with_mean: bool = True) -> DataFrame:
    """Q2: nulls of ``value`` (and its mean) per group; null keys dropped as
    pandas ``groupby`` does."""
    group, df = _cols(group), nan_to_null(df)
    aggs = [F.count_if(F.col(value).isNull()).alias("missing_values")]
    if with_mean:
        aggs.append(F.avg(value).alias("mean_value"))
    keep = F.lit(True)
    for g in group:
        keep = keep & F.col(g).isNotNull()
    return df.where(keep).groupBy(*group).agg(*aggs)


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q3: count, mean, std, min, 25/50/75 %, max per column (exact
    quantiles, pandas ``describe``). One unpivot, one grouped aggregate, one
    grouped distributed quantile pass."""
    long = ordered.long_form(nan_to_null(df), columns)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = ordered.exact_quantiles(long, "value", [0.25, 0.5, 0.75], group=["feature"])
    qp = q.groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
        for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])
    return basic.join(qp, "feature", "left")


def duplicate_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Q4: rows that repeat an earlier row (by ``key`` order) on ``columns`` (default: all but the key).

    128-bit fingerprints are counted first (slim rows, combined map-side). Only rows whose
    fingerprint occurs twice are looked at in full. They are written to the shared folder, so that what follows is planned
    on a plain table: over many computed columns the optimizer's constraints would else multiply with every column.
    Then the first key per combination of values, compared exactly, and the rows that are not the first. Fingerprints and
    first keys are broadcast behind a size check (``join_fitted``), so full rows do not move at all in the common case,
    else the suspected ones by their fingerprint. A hot group is one combined row per task, never one task."""
    cols = _cols(columns) or [c for c in df.columns if c != key]
    f1, f2 = "_lw_print1", "_lw_print2"
    rows = df.withColumns({f1: F.xxhash64(*cols), f2: F.xxhash64(F.lit(1), *cols)})
    repeated = rows.groupBy(f1, f2).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    suspects, path = join_fitted(rows, repeated, [f1, f2]), scratch_path(df.sparkSession, "suspects")
    suspects.write.parquet(path)
    suspects = df.sparkSession.read.schema(suspects.schema).parquet(path)
    values = F.struct(*cols)
    first = suspects.groupBy(f1, f2, values.alias("_values")).agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    same = join_fitted(suspects, first, [f1, f2]).where(values.eqNullSafe(F.col("_values")))
    return same.where(F.col(key) != F.col("_first")).select(*df.columns)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5/Q6: (feature, value, count) for each column's distinct values."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]) \
             .unpivot([], list(columns), "feature", "value")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5: distinct combinations of columns with their counts."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Q6."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def schema_report(df: DataFrame) -> DataFrame:
    """Q7: column name, Spark type, non-null count (one aggregate)."""
    agg = nan_to_null(df).agg(*[F.count(c).alias(f"{c}__non_null") for c in df.columns])
    t = _transpose(agg, df.columns, ["non_null"])
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return t.select("column", types[F.col("column")].alias("type"), "non_null")


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q8: min and max of every numeric column, transposed to rows."""
    agg = nan_to_null(df).agg(*[x for c in columns for x in (F.min(c).cast("double").alias(f"{c}__min"),
                                                  F.max(c).cast("double").alias(f"{c}__max"))])
    return _transpose(agg, columns, ["min", "max"])


def first_token_match(df: DataFrame, text: str, reference: str, constant: float = 0.0) -> DataFrame:
    """Q9: share of rows whose text's first ``_`` token (after lower + space
    to ``_``) equals the reference's first ``_`` token. ``constant`` * rows is
    added to the match count (the reference adds 0.0094; default 0)."""
    a = fx.first_token(fx.standardise_text(text), "_")
    b = fx.first_token(F.col(reference), "_")
    m = F.coalesce((a == b).cast("int"), F.lit(0))
    n = F.count(F.lit(1))
    matches = F.sum(m) + F.lit(constant) * n
    return df.agg(matches.cast("double").alias("n_matches"),
                  (matches.cast("double") / n * 100).alias("pct_matches"))


def spread_report(df: DataFrame, column: str, lo: float = 0.25, hi: float = 0.75) -> DataFrame:
    """Q10: low/high quantile, their spread, min and max: all from the selection's own
    two reads (the extremes are the quantiles 0 and 1)."""
    q = [r["value"] for r in sorted(ordered.exact_quantiles(df, column, [0.0, lo, hi, 1.0]).collect(), key=lambda r: r["prob"])]
    mn, q_lo, q_hi, mx = q or [None] * 4
    t = df.schema[column].dataType.simpleString()
    row = df.sparkSession.createDataFrame([(column, q_lo, q_hi, None if q_lo is None else q_hi - q_lo, mn, mx)],
                                          "column string, q_low double, q_high double, spread double, min double, max double")
    return row.withColumns({"min": F.col("min").cast(t), "max": F.col("max").cast(t)})


def zscore_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Q11: count of |z| > threshold per column (z with the sample std)."""
    long = ordered.long_form(nan_to_null(df), columns)
    stats = long.groupBy("feature").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    j = join_fitted(long, stats, "feature")  # one row per column
    z = fx.abs_zscore(F.col("value"), F.col("_m"), F.col("_s"))
    return j.groupBy("feature").agg(F.count(F.when(z > threshold, 1)).alias("n_outliers"),
                                    F.max(z).alias("max_abs_z"))


def _bin_expr(x, mn, mx, bins: int):
    width = mx - mn
    raw = F.floor((x - mn) / width * bins) + 1
    return F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Q12: equal-width histogram between min and max; the last bin is closed
    (x = max falls in bin ``bins``)."""
    c = F.col(column).cast("double")
    mn, mx = df.agg(*[f(F.when(~F.isnan(c), c)) for f in (F.min, F.max)]).collect()[0]
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, count bigint")
    mn, mx = F.lit(float(mn)), F.lit(float(mx))
    x = F.col(column)
    b = _bin_expr(x, mn, mx, bins)
    counts = df.where(x.isNotNull() & ~F.isnan(x.cast("double"))).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))  # empty bins are rows too
    h = every.join(counts, "bin", "left").fillna(0, ["count"])
    return h.select("bin", (mn + (F.col("bin") - 1) * (mx - mn) / bins).alias("bin_start"),
                    "count")


def density_bins(mn, mx, sd, n) -> int:
    """Bins of a sixteenth of the bandwidth between the extremes; 0 where there is no curve."""
    if not n or not sd or mn == mx:
        return 0
    return max(1, math.ceil(16 * (float(mx) - float(mn)) / (float(sd) * float(n) ** -0.2)))


def density_curve(fine: DataFrame, mn, mx, sd, n, grid_points: int, bins: int | None = None) -> DataFrame:
    """(point, x, density) on an even grid from a table of fine bins (fb, w). A bin adds to the grid points
    within CUT_OFF bandwidths only, so a bin's work does not grow with the grid's span."""
    bins, grid_points = bins or density_bins(mn, mx, sd, n), max(2, grid_points)
    mn, mx, h = float(mn), float(mx), float(sd) * float(n) ** -0.2
    step, width = (mx - mn) / (grid_points - 1), (mx - mn) / bins
    c = f"({mn!r}D + (fb - 0.5D) * {width!r}D)"
    reach = CUT_OFF * h
    near = (f"sequence(greatest(0, CAST(ceil(({c} - {reach!r}D - {mn!r}D) / {step!r}D) AS INT)), "
            f"least({grid_points - 1}, CAST(floor(({c} + {reach!r}D - {mn!r}D) / {step!r}D) AS INT)))")
    some = f"ceil(({c} - {reach!r}D - {mn!r}D) / {step!r}D) <= floor(({c} + {reach!r}D - {mn!r}D) / {step!r}D)"
    pairs = fine.where(F.expr(some)).select(F.expr(f"explode({near})").alias("point"), "w", F.expr(c).alias("c"))
    u = f"(({mn!r}D + point * {step!r}D - c) / {h!r}D)"
    heights = pairs.groupBy("point").agg(F.expr(f"sum(w * exp(-0.5D * {u} * {u}))").alias("s"))
    grid = fine.sparkSession.range(grid_points).select(F.col("id").cast("int").alias("point"))
    return grid.join(heights, "point", "left").select(
        "point", F.expr(f"{mn!r}D + point * {step!r}D").alias("x"), F.expr(f"coalesce(s, 0D) / {float(n) * h * math.sqrt(2 * math.pi)!r}D").alias("density"))


#: Bandwidths beyond which a Gaussian adds less than 1e-14 of its peak.
CUT_OFF = 8.0


def kde(df: DataFrame, column: str, grid_points: int = 64, fine_bins: int | None = None) -> DataFrame:
    """Q13: Gaussian kernel density (Scott bandwidth sigma * n^-1/5) on an
    even grid from min to max, evaluated over a fine histogram of the data
    (bin centres weighted by counts): one pass and a table of bins. Bins are a
    sixteenth of the bandwidth wide unless ``fine_bins`` is given, so the curve stays as
    close as the data grow (within 0.1 % of the peak). NaN is missing. A constant column has no
    curve: no rows."""
    x = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    mn, mx, sd, n = df.agg(F.min(x), F.max(x), F.stddev_samp(x), F.count(x)).collect()[0]
    bins = fine_bins or density_bins(mn, mx, sd, n)
    if not density_bins(mn, mx, sd, n):
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    fine = (df.where(x.isNotNull()).groupBy(_bin_expr(x, F.lit(float(mn)), F.lit(float(mx)), bins).alias("fb"))
            .agg(F.count(F.lit(1)).alias("w")))
    return density_curve(fine, mn, mx, sd, n, grid_points, bins)


def box_stats(df: DataFrame, value: str, group: Sequence[str] | str | None = None,
              k: float = 1.5) -> DataFrame:
    """Q14: per group Q1, median, Q3, whiskers (extreme values inside the
    1.5 IQR fences), outlier count and mean."""
    group, df = _cols(group), nan_to_null(df)
    q = ordered.exact_quantiles(df, value, [0.25, 0.5, 0.75], group=group)
    qs = q.groupBy(*group).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(nm)
                                 for p, nm in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    qs = qs.withColumn("_lo", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
           .withColumn("_hi", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    x = F.col(value)
    d = df.where(x.isNotNull()).select(*group, value)
    j = join_fitted(d, qs, group)
    return j.groupBy(*group).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(x >= F.col("_lo"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("_hi"), x)).alias("whisker_high"),
        F.count(F.when((x < F.col("_lo")) | (x > F.col("_hi")), 1)).alias("n_outliers"),
        F.avg(x).alias("mean"),
    )
