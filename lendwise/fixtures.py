"""Loan-shaped view over the driver's TPC-H-like tables.

The library works on any table with the loan schema (``schema.LOAN_SCHEMA``);
tests and the bench derive one from ``orders x customer x nation`` so the work
grows with the scale factor. One row per order.

``loans(spark, sf_dir)`` is the Spark form; ``LOANS_SQL`` is the same view as
plain SQL for the DuckDB oracle (tables pre-registered under their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an under-partitioned scan.

    A fact table stored as one file with one row group scans as a single
    task, and everything narrow after it (joins to broadcast dimensions,
    projections) would run on one core. Off unless ``spark.lendwise.spreadScans``
    is true. If the scan has fewer partitions than
    the cluster's default parallelism, round-robin it once; on a large table
    (many files and row groups) the check is false and nothing changes."""
    spark = df.sparkSession
    if spark.conf.get("spark.lendwise.spreadScans", "false").lower() != "true":
        return df
    try:
        target = spark.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()   # a bare scan: plans it, runs no job
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave as is
        return df
    return df.repartition(target) if parts < target else df


def _case(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``loans`` view. Joins are left to Catalyst/AQE: ``nation`` is tiny and
    goes broadcast by its file size; ``customer`` grows with the data and is
    broadcast only while under the size threshold, else sort-merge joined."""
    o = spread(table(spark, sf_dir, "orders"))
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)

    ok, ck, price, bal = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"), F.col("c_acctbal")
    cm12 = ck % 12
    return j.select(
        ok.alias("loan_id"),
        ck.alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("issue_date"),
        price.alias("loan_amount"),
        F.when(ok % 10 == 0, price * 0.9).otherwise(price).alias("funded_amount"),
        ((bal + 1000) * 10).alias("annual_inc"),
        F.when(ok % 3 == 0, (bal + 1000) * 15).alias("annual_inc_joint"),
        F.when(ok % 20 == 0, F.lit(None).cast("double"))
         .otherwise((5 + ok % 26) / F.lit(100.0)).alias("int_rate"),
        (ok % 37).alias("grade"),
        F.when(ok % 2 == 0, " 36 months").otherwise(" 60 months").alias("term"),
        F.when(cm12 == 0, F.lit(None).cast("string"))
         .when(cm12 == 1, "< 1 year").when(cm12 == 2, "1 year").when(cm12 == 11, "10+ years")
         .otherwise(F.concat((cm12 - 1).cast("string"), F.lit(" years"))).alias("emp_length"),
        F.when(ck % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lower("c_mktsegment"), F.lit("_"), (ck % 7).cast("string"))).alias("emp_title"),
        _case(ck % 5, {0: "MORTGAGE", 1: "RENT", 2: "OWN", 3: "OTHER"}, "NONE").alias("home_ownership"),
        _case(F.col("o_orderstatus"), {"F": "Verified", "O": "Not Verified"}, "Source Verified")
        .alias("verification_status"),
        _case(F.substring("o_orderpriority", 1, 1),
              {"1": "Default", "2": "Current", "3": "Fully Paid", "4": "Charged Off"}, "Late")
        .alias("loan_status"),
        F.col("n_name").alias("addr_state"),
        F.col("n_name").alias("state"),
        _case(ok % 4, {0: "debt_consolidation", 1: "credit_card", 2: "car"}, "small_business").alias("purpose"),
        F.when(ok % 11 == 0, F.lit(None).cast("string"))
         .when(ok % 4 == 0, "Debt consolidation").when(ok % 4 == 1, "Credit card")
         .when(ok % 4 == 2, "Auto").otherwise("Business").alias("description"),
        _case(ok % 5, {0: "Individual", 1: "INDIVIDUAL", 2: "JOINT", 3: "Joint App"}, "DIRECT_PAY").alias("type"),
        (ok % 50 == 0).alias("pymnt_plan"),
        F.when(ok % 100 == 0, F.lit(0.0)).otherwise(price / 10).alias("avg_cur_bal"),
        F.when(ok % 100 == 0, F.lit(0.0)).otherwise(price).alias("tot_cur_bal"),
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with raw-style headers (spaces, capitals), as files arrive."""
    df = loans(spark, sf_dir)
    return df.toDF(*[" ".join(w.capitalize() for w in c.split("_")) for c in df.columns])


# The same view for the DuckDB oracle.
LOANS_SQL = """
loans AS (
  SELECT
    o_orderkey AS loan_id,
    o_custkey AS customer_id,
    CAST(o_orderdate AS DATE) AS issue_date,
    o_totalprice AS loan_amount,
    CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 0.9 ELSE o_totalprice END AS funded_amount,
    (c_acctbal + 1000) * 10 AS annual_inc,
    CASE WHEN o_orderkey % 3 = 0 THEN (c_acctbal + 1000) * 15 END AS annual_inc_joint,
    CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE (5 + o_orderkey % 26) / CAST(100 AS DOUBLE) END AS int_rate,
    o_orderkey % 37 AS grade,
    CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
    CASE WHEN o_custkey % 12 = 0 THEN NULL WHEN o_custkey % 12 = 1 THEN '< 1 year'
         WHEN o_custkey % 12 = 2 THEN '1 year' WHEN o_custkey % 12 = 11 THEN '10+ years'
         ELSE concat(CAST(o_custkey % 12 - 1 AS VARCHAR), ' years') END AS emp_length,
    CASE WHEN o_custkey % 9 = 0 THEN NULL
         ELSE concat(lower(c_mktsegment), '_', CAST(o_custkey % 7 AS VARCHAR)) END AS emp_title,
    CASE o_custkey % 5 WHEN 0 THEN 'MORTGAGE' WHEN 1 THEN 'RENT' WHEN 2 THEN 'OWN'
         WHEN 3 THEN 'OTHER' ELSE 'NONE' END AS home_ownership,
    CASE o_orderstatus WHEN 'F' THEN 'Verified' WHEN 'O' THEN 'Not Verified'
         ELSE 'Source Verified' END AS verification_status,
    CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Default' WHEN '2' THEN 'Current'
         WHEN '3' THEN 'Fully Paid' WHEN '4' THEN 'Charged Off' ELSE 'Late' END AS loan_status,
    n_name AS addr_state,
    n_name AS state,
    CASE o_orderkey % 4 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card'
         WHEN 2 THEN 'car' ELSE 'small_business' END AS purpose,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Debt consolidation'
         WHEN o_orderkey % 4 = 1 THEN 'Credit card' WHEN o_orderkey % 4 = 2 THEN 'Auto'
         ELSE 'Business' END AS description,
    CASE o_orderkey % 5 WHEN 0 THEN 'Individual' WHEN 1 THEN 'INDIVIDUAL' WHEN 2 THEN 'JOINT'
         WHEN 3 THEN 'Joint App' ELSE 'DIRECT_PAY' END AS type,
    o_orderkey % 50 = 0 AS pymnt_plan,
    CASE WHEN o_orderkey % 100 = 0 THEN 0 ELSE o_totalprice / 10 END AS avg_cur_bal,
    CASE WHEN o_orderkey % 100 = 0 THEN 0 ELSE o_totalprice END AS tot_cur_bal
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""


def with_loans(body: str, *ctes: str) -> str:
    """Oracle SQL text: ``WITH loans AS (...), <ctes> <body>``."""
    parts = [LOANS_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
