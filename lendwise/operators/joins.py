"""Joins and set operations.

``join_fitted`` is the one place that broadcasts: a fitted table (one row per
group) is collected behind a check of its size and joined without moving the
rows; a larger one is an equi-join, whose skewed keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A fitted table is collected and broadcast up to these sizes.
FITTED_ROWS, FITTED_BYTES = 20_000, 8 << 20


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    return [xs] if isinstance(xs, str) else list(xs)


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left",
               null_safe: bool = True) -> DataFrame:
    """Equi-join ``big`` to ``small`` on ``on``, without a hint. With
    ``null_safe`` a null key matches a null key (group tables keep a null group)."""
    on = _cols(on)
    if not on:
        raise ValueError("join_small needs at least one key (no cross joins)")
    if null_safe:
        r = small.select(*[F.col(k).alias(f"_r_{k}") for k in on],
                         *[c for c in small.columns if c not in on])
        cond = None
        for k in on:
            c = big[k].eqNullSafe(r[f"_r_{k}"])
            cond = c if cond is None else cond & c
        return big.join(r, cond, how).drop(*[f"_r_{k}" for k in on])
    return big.join(small, on, how)


def join_fitted(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
                max_rows: int = FITTED_ROWS, max_bytes: int = FITTED_BYTES) -> DataFrame:
    """Join rows to a table of fitted values, one row per group (null groups
    match). The table is computed now; up to ``max_rows`` rows and
    ``max_bytes`` it is broadcast, so ``big`` is not shuffled by its few
    groups. Without keys it is the one row of a global fit, added as literals."""
    on = _cols(on)
    rows = small.limit(max_rows + 1).collect()
    if not on:
        one = big.sparkSession.createDataFrame(rows, small.schema)  # a global fit: exactly one row
        return big.select("*", *[one.select(c).scalar().alias(c) for c in small.columns])
    if len(rows) > max_rows or sum(len(str(r)) for r in rows) > max_bytes:
        return join_small(big, small, on, how)
    return join_small(big, F.broadcast(big.sparkSession.createDataFrame(rows, small.schema)), on, how)


def dedupe_dim(dim: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
               keep: str = "first") -> DataFrame:
    """One row per key for a map table (J1): explicit first/last-wins rule.

    ``min_by``/``max_by`` on the ordering keeps it a partial aggregate."""
    key, order = _cols(key), _cols(order)
    others = [c for c in dim.columns if c not in key]
    pick = F.min_by if keep == "first" else F.max_by
    s = F.struct(*[F.col(c) for c in others])
    o = F.struct(*[F.col(c) for c in order])
    return dim.groupBy(*key).agg(pick(s, o).alias("_row")).select(*key, *[F.col(f"_row.{c}").alias(c)
                                                                         for c in others])


def map_values(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str) -> DataFrame:
    """``df[key].map(dict(dim))`` as a left join; unmatched -> null.
    ``dim`` must be unique on ``dim_key`` (use ``dedupe_dim``)."""
    d = dim.select(F.col(dim_key).alias(key), F.col(value).alias(out))
    return join_fitted(df, d, [key], "left")


def assign_aligned(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Index-aligned column assignment = left join on a key that must be
    unique on the right (raises otherwise; a non-unique key would multiply rows)."""
    dup = right.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"key {key!r} is not unique on the right side")
    return left.join(right.select(key, *columns), key, "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """One ``unionByName`` over a list (not one union per row)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def rows_equal_group_max(df: DataFrame, group: Sequence[str] | str, value: str) -> DataFrame:
    """Rows whose ``value`` equals the max of their group (ties kept),
    as aggregate + join rather than a window over the group."""
    group = _cols(group)
    mx = df.groupBy(*group).agg(F.max(value).alias("_max"))
    j = df.join(mx, group)
    return j.where(F.col(value) == F.col("_max")).drop("_max")


def top_n(df: DataFrame, n: int, order) -> DataFrame:
    """O2: ``orderBy(...).limit(n)`` -> TakeOrderedAndProject (per-task top n)."""
    return df.orderBy(*order).limit(n)

