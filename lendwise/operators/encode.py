"""Category encoding and the lookup table.

Fit = small parameters (sorted category lists, value -> code maps); every
fitted step also returns its lookup rows ``(feature, original_value,
encoded_value)`` as data, so the pipeline unions them once at the end.
Transform = projections only: one-hot columns are ``(c == v)`` expressions,
code maps are inlined as a map literal while small, else joined (broadcast
only with a known size). Both work unchanged on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.functions import features as fx
from lendwise.operators import ordered
from lendwise.operators.joins import join_fitted
from lendwise.operators.outliers import category_labels

LOOKUP_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("original_value", T.StringType()),
    T.StructField("encoded_value", T.StringType()),
])


def lookup_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Lookup rows as a DataFrame of strings (None stays null)."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 LOOKUP_SCHEMA)


def empty_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOOKUP_SCHEMA)


def onehot_columns(column: str | Column, categories: Sequence[str], prefix: str,
                   sep: str = "_") -> list[Column]:
    """One int column per category; null or unseen -> all zeros."""
    c = F.col(column) if isinstance(column, str) else column
    return [F.coalesce((c == v).cast("int"), F.lit(0)).alias(f"{prefix}{sep}{v}") for v in categories]


def fit_onehot(df: DataFrame, column: str, prefix: str | None = None, drop_first: bool = True,
               max_categories: int = 1000, feature: str | None = None) -> tuple[list, list[tuple]]:
    """Sorted categories and lookup rows (all but the first when
    ``drop_first``, as the reference's encoder does)."""
    cats = category_labels(df, column, max_categories)
    p = prefix or column
    logged = cats[1:] if drop_first else cats
    return cats, [(feature or column, v, f"{p}_{v}") for v in logged]


def onehot(df: DataFrame, column: str, prefix: str | None = None, categories: Sequence[str] | None = None,
           drop_first_lookup: bool = True) -> tuple[DataFrame, list[tuple]]:
    """Fit (unless ``categories`` given) + transform in one select."""
    if categories is None:
        categories, rows = fit_onehot(df, column, prefix, drop_first_lookup)
    else:
        rows = [(column, v, f"{prefix or column}_{v}") for v in categories]
    return df.select("*", *onehot_columns(column, categories, prefix or column)), rows


def code_map_expr(column: str | Column, mapping: dict) -> Column:
    """Value -> code through a map literal (small maps, no join)."""
    c = F.col(column) if isinstance(column, str) else column
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[c]


def fit_label_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes 0..k-1 in value order (alphabetical), distributed."""
    return ordered.dense_codes(df, column, code_col="code")


def fit_frequency_codes(df: DataFrame, column: str) -> DataFrame:
    """Most frequent -> 0, ties alphabetical."""
    return ordered.frequency_codes(df, column, code_col="code")


def apply_codes(df: DataFrame, column: str, codes: DataFrame, out: str,
                cast: str | None = None) -> DataFrame:
    """Encode ``column`` with a fitted ``(column, code)`` table: a left
    equi-join, broadcast behind a check of the table's size."""
    c = codes.select(F.col(column), (F.col("code").cast(cast) if cast else F.col("code")).alias(out))
    return join_fitted(df, c, [column], "left")


def label_encode(df: DataFrame, column: str, out: str | None = None,
                 feature: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(encoded frame, lookup rows)."""
    codes = fit_label_codes(df, column)
    lk = codes.select(F.lit(feature or column).alias("feature"), F.col(column).cast("string")
                      .alias("original_value"), F.col("code").cast("string").alias("encoded_value"))
    return apply_codes(df, column, codes, out or f"{column}_encoded"), lk


def lookup_codes(lookup: DataFrame, feature: str, column: str) -> DataFrame:
    """The ``(column, code)`` table for one feature of a lookup table;
    a repeated original value keeps the row with the highest ``seq`` where the
    table stores that column, else the greatest code (rows of a stored table
    have no order of their own)."""
    lk = lookup.where(F.col("feature") == feature)
    rank = F.struct("seq", "encoded_value") if "seq" in lookup.columns else F.col("encoded_value")
    last = lk.groupBy("original_value").agg(F.max_by("encoded_value", rank).alias("code"))
    return last.select(F.col("original_value").alias(column), "code")


def encode_from_lookup(df: DataFrame, lookup: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Map ``column`` through the stored lookup rows of that feature."""
    return apply_codes(df, column, lookup_codes(lookup, column, column), out or f"{column}_encoded")


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """N7 fit: min/max of several columns in one aggregate."""
    r = df.agg(*[x for c in columns for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))]) \
          .collect()[0]
    return {c: (r[f"{c}__min"], r[f"{c}__max"]) for c in columns}


def minmax_scale(df: DataFrame, ranges: dict[str, tuple[float, float]], lo: float = 0.0,
                 hi: float = 15.0) -> DataFrame:
    """N7 transform with stored ranges (a one-row stream is not refitted)."""
    return df.withColumns({c: fx.minmax_scale(c, mn, mx, lo, hi) for c, (mn, mx) in ranges.items()})


def before_after_pairs(df: DataFrame, before: str, after: str) -> DataFrame:
    """Distinct (before, after) pairs of a transform, kept distributed."""
    return df.select(before, after).distinct()
