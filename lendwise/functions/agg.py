"""Aggregate Column builders with engine-independent results.

Floating-point sums depend on the order rows arrive in, which differs between
runs and engines. Money columns have a fixed number of decimals, so we sum
them as DECIMAL (exact, still a partial/final hash aggregate) and convert once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendwise.functions.features import ColumnOrName, _c

MONEY_SCALE = 4
MONEY_TYPE = f"decimal(24,{MONEY_SCALE})"


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of a money-like column, as double."""
    return F.sum(_c(c).cast(MONEY_TYPE)).cast("double")


def money_avg(c: ColumnOrName) -> Column:
    """Exact-sum mean: double(sum) / count of non-null values."""
    x = _c(c)
    return F.try_divide(money_sum(x), F.count(x).cast("double"))


def rate_avg(c: ColumnOrName) -> Column:
    """Mean of rates: a plain average, no rounding of the values."""
    return F.avg(_c(c))


def round6(c: Column) -> Column:
    return F.round(c, 6)


def money_sum_sql(expr: str) -> str:
    """The same aggregate as SQL text (used by the SQL forms and the oracle)."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(24,{MONEY_SCALE}))) AS DOUBLE)"


def money_avg_sql(expr: str) -> str:
    return f"({money_sum_sql(expr)} / CAST(COUNT({expr}) AS DOUBLE))"
