"""Binning, log transforms and outlier capping.

Fitting computes a handful of quantiles (exact by default, distributed; or a
sketch with ``approx=True``) and collects them - a bounded number of floats.
Applying is a pure projection, so fitted caps work on batch and stream alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.functions import features as fx
from lendwise.operators import ordered


def fit_quantiles(df: DataFrame, column: str, probs: Sequence[float], approx: bool = False,
                  relative_error: float = 0.01) -> list[float]:
    """Quantiles of one column as Python floats, in the order of ``probs``."""
    rows = ordered.quantiles(df, column, probs, approx=approx, relative_error=relative_error).collect()
    by = {round(r["prob"], 12): r["value"] for r in rows}
    return [by.get(round(float(p), 12)) for p in probs]


def fit_quantiles_multi(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                        approx: bool = False) -> dict[str, list[float]]:
    """Quantiles of several columns in one job (unpivot, group by column)."""
    long = ordered.long_form(df, columns)
    rows = ordered.quantiles(long, "value", probs, group=["feature"], approx=approx).collect()
    out: dict[str, dict] = {c: {} for c in columns}
    for r in rows:
        out[r["feature"]][round(r["prob"], 12)] = r["value"]
    return {c: [out[c].get(round(float(p), 12)) for p in probs] for c in columns}


def iqr_fences(q1: float, q3: float, k: float = 1.5) -> tuple[float, float]:
    """(Q1 - k*IQR, Q3 + k*IQR); no values, no fences (nothing is capped)."""
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def category_labels(df: DataFrame, column: str, max_values: int = 1000) -> list:
    """Sorted distinct non-null values of a category column (a fit parameter
    that becomes output columns, so its size is checked, never capped)."""
    vals = (df.select(column).where(F.col(column).isNotNull()).distinct()
            .orderBy(column).limit(max_values + 1).collect())
    if len(vals) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values")
    return [r[0] for r in vals]


def qcut_edges(df: DataFrame, column: str, q: int, approx: bool = False) -> list[float]:
    """B1: pandas ``qcut`` edges (min, interior quantiles, max); raises on
    duplicate edges like pandas does."""
    probs = [i / q for i in range(q + 1)]
    edges = fit_quantiles(df, column, probs, approx=approx)
    if any(e is None for e in edges):
        raise ValueError(f"{column} has no values to bin")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges must be unique: {edges}")
    return edges


def qcut_expr(column: str | Column, interior: Sequence[float], labels: Sequence[str]) -> Column:
    """B1: right-closed bins (first bin includes its left edge); null -> null."""
    x = F.col(column) if isinstance(column, str) else column
    if len(labels) != len(interior) + 1:
        raise ValueError("need one more label than interior edges")
    if any(b <= a for a, b in zip(interior, interior[1:])):
        raise ValueError(f"bin edges must be unique: {list(interior)}")
    expr = None
    for e, lab in zip(interior, labels):
        expr = F.when(x <= e, lab) if expr is None else expr.when(x <= e, lab)
    return expr.when(x.isNotNull(), labels[-1])


def qcut(df: DataFrame, column: str, q: int, labels: Sequence[str], out: str,
         approx: bool = False) -> DataFrame:
    edges = qcut_edges(df, column, q, approx)
    return df.withColumn(out, qcut_expr(column, edges[1:-1], labels))


def fit_iqr_caps(df: DataFrame, column: str, k: float = 1.5, approx: bool = False) -> tuple[float, float]:
    q1, q3 = fit_quantiles(df, column, [0.25, 0.75], approx=approx)
    return iqr_fences(q1, q3, k)


def fit_percentile_caps(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.95,
                        approx: bool = False) -> tuple[float, float]:
    q = fit_quantiles(df, column, [lo, hi], approx=approx)
    return q[0], q[1]


def cap_iqr(df: DataFrame, column: str, out: str | None = None, k: float = 1.5,
            approx: bool = False) -> DataFrame:
    """B6."""
    lo, hi = fit_iqr_caps(df, column, k, approx)
    return df.withColumn(out or column, fx.cap(column, lo, hi))


def cap_percentiles(df: DataFrame, column: str, out: str | None = None, lo: float = 0.05,
                    hi: float = 0.95, approx: bool = False) -> DataFrame:
    """B7."""
    a, b = fit_percentile_caps(df, column, lo, hi, approx)
    return df.withColumn(out or column, fx.cap(column, a, b))


def cap_lower_iqr(df: DataFrame, column: str, out: str | None = None, k: float = 1.5,
                  approx: bool = False) -> DataFrame:
    """Lower fence only."""
    lo, _ = fit_iqr_caps(df, column, k, approx)
    return df.withColumn(out or column, fx.cap(column, lower=lo))
