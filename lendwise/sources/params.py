"""Fitted-parameter store.

Parameters are a small typed table ``(fit_id, name, value_double,
value_string)`` in Parquet under a shared folder (by default inside
``spark.checkpoint.dir``). Saving overwrites the rows of one ``fit_id`` (no
stale first-match after a rerun); loading returns the latest fit.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.session import checkpoint_dir

PARAMS_SCHEMA = T.StructType([
    T.StructField("fit_id", T.StringType()),
    T.StructField("fitted_at", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("value_double", T.DoubleType()),
    T.StructField("value_string", T.StringType()),
])


class ParamStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def scratch(cls, spark: SparkSession, name: str) -> "ParamStore":
        """A store under the shared checkpoint folder, unique per call."""
        return cls(spark, f"{checkpoint_dir(spark).rstrip('/')}/lendwise-params/{name}-{uuid.uuid4().hex}")

    def save(self, params: dict, fit_id: str | None = None) -> str:
        fit_id = fit_id or uuid.uuid4().hex
        now = time.time_ns()
        rows = []
        for k, v in params.items():
            if isinstance(v, bool) or not isinstance(v, (int, float)) or v is None:
                rows.append((fit_id, now, k, None, None if v is None else str(v)))
            else:
                rows.append((fit_id, now, k, float(v), None))
        df = self.spark.createDataFrame(rows, PARAMS_SCHEMA)
        # One small file per fit; partitioned by fit_id so a rerun replaces it.
        (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("fit_id").parquet(self.path))
        return fit_id

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def load(self, fit_id: str | None = None) -> dict:
        """Parameters of ``fit_id`` (default: the latest fit); a missing name
        reads as absent (``dict.get`` -> None)."""
        t = self.table()
        if fit_id is None:
            latest = t.agg(F.max_by("fit_id", "fitted_at")).collect()[0][0]
            fit_id = latest
        rows = t.where(F.col("fit_id") == fit_id).select("name", "value_double", "value_string").collect()
        return {r["name"]: (r["value_double"] if r["value_double"] is not None else r["value_string"])
                for r in rows}

    def get(self, name: str, fit_id: str | None = None):
        return self.load(fit_id).get(name)
