"""Imputation.

Fitting returns small DataFrames or scalars; applying is a projection plus,
for per-group values, a join to a fitted table with one row per group (never a
window over few groups, and no shuffle of the rows by their group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.operators.joins import join_fitted


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    return [xs] if isinstance(xs, str) else list(xs)


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """``coalesce(c, value)`` per column (``fillna`` silently skips
    type-mismatched columns; this raises instead)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in values.items()})


def fill_from(df: DataFrame, target: str, source: str | Column, out: str | None = None) -> DataFrame:
    """Fill ``target`` from another column."""
    src = F.col(source) if isinstance(source, str) else source
    return df.withColumn(out or target, F.coalesce(F.col(target), src))


def group_means(df: DataFrame, value: str, group: Sequence[str] | str,
                out: str = "group_mean") -> DataFrame:
    """Mean of ``value`` per group (null group keys kept, pandas would drop them)."""
    return df.groupBy(*_cols(group)).agg(F.avg(value).alias(out))


def fill_group_mean(df: DataFrame, value: str, group: Sequence[str] | str,
                    out: str | None = None) -> DataFrame:
    """Fill nulls with the mean of the row's group (pandas
    ``groupby().transform(fillna(mean))``). Aggregate + join, not a window: a
    window over few groups funnels every row of a group into one task."""
    group = _cols(group)
    whole = F.lit(True)  # a group with any null key is no group, as in pandas
    for g in group:
        whole = whole & F.col(g).isNotNull()
    j = join_fitted(df, group_means(df, value, group, "_gm").where(whole), group, how="left")
    return j.withColumn(out or value, F.coalesce(F.col(value), F.col("_gm"))).drop("_gm")


def mode_values(df: DataFrame, value: str, group: Sequence[str] | str | None = None,
                out: str = "mode") -> DataFrame:
    """Most frequent non-null value (ties -> smallest) per group.

    Two aggregates, both partial/final: counts per (group, value), then
    ``min_by(value, (-count, value))`` per group. Never holds a group's
    distinct values in one task, unlike the ``mode`` aggregate."""
    group = _cols(group)
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*group).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias(out))


def mode_value(df: DataFrame, value: str):
    """The global non-null mode as a Python scalar (a fit parameter)."""
    r = mode_values(df, value).collect()
    return r[0]["mode"] if r else None


def fill_mode(df: DataFrame, value: str, out: str | None = None, mode=None) -> DataFrame:
    """Fill with the (fitted or given) global mode."""
    m = mode_value(df, value) if mode is None else mode
    return df.withColumn(out or value, F.coalesce(F.col(value), F.lit(m)))


def fill_group_mode(df: DataFrame, value: str, group: Sequence[str] | str,
                    out: str | None = None, fallback=None) -> DataFrame:
    """Fill with the mode of the row's group; rows whose group has no
    mode (or a null group) fall back to ``fallback``."""
    group = _cols(group)
    modes = mode_values(df, value, group, "_gmode")
    j = join_fitted(df, modes, group, how="left")
    fill = F.coalesce(F.col("_gmode"), F.lit(fallback)) if fallback is not None else F.col("_gmode")
    return j.withColumn(out or value, F.coalesce(F.col(value), fill)).drop("_gmode")


def missing_flag(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Q16."""
    return df.withColumn(out or f"{value}_missing", F.col(value).isNull())
