"""Loan schema, column-name normalisation (P1) and the NaN boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Normalised loan schema (names after P1). Explicit, so CSV reads skip inference.
LOAN_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("loan_id", T.LongType()),
    T.StructField("emp_title", T.StringType()),
    T.StructField("emp_length", T.StringType()),
    T.StructField("home_ownership", T.StringType()),
    T.StructField("annual_inc", T.DoubleType()),
    T.StructField("annual_inc_joint", T.DoubleType()),
    T.StructField("verification_status", T.StringType()),
    T.StructField("addr_state", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("avg_cur_bal", T.DoubleType()),
    T.StructField("tot_cur_bal", T.DoubleType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("loan_amount", T.DoubleType()),
    T.StructField("funded_amount", T.DoubleType()),
    T.StructField("term", T.StringType()),
    T.StructField("int_rate", T.DoubleType()),
    T.StructField("grade", T.LongType()),
    T.StructField("issue_date", T.StringType()),
    T.StructField("pymnt_plan", T.BooleanType()),
    T.StructField("type", T.StringType()),
    T.StructField("purpose", T.StringType()),
    T.StructField("description", T.StringType()),
])


def normalise_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn spaces into ``_``."""
    new = [normalise_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Null is the only missing marker: turn NaN in float columns into null."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if c in floats else F.col(c)
        for c in df.columns
    ])


def check_unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once (empty result = key is unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
