"""SQL surface (S9): the M3 analyses as Spark SQL over a temp view.

Parameters are bound with named arguments (``spark.sql(q, args=...)``), not
string formatting. The view carries the prepared columns and the skew-safe
lag features, so the SQL only filters and aggregates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lendwise.functions.agg import money_avg_sql, money_sum_sql
from lendwise.plans import analytics as an

A8 = f"""
SELECT emp_length,
       CASE WHEN annual_inc > :q3 THEN 'High' WHEN annual_inc > :q1 THEN 'Mid'
            WHEN annual_inc IS NOT NULL THEN 'Low' END AS income_range,
       {money_avg_sql('loan_amount')} AS avg_loan_amount,
       avg(int_rate) AS avg_interest_rate
FROM {{view}} WHERE loan_status = :status
GROUP BY emp_length, income_range"""

A9 = f"""
SELECT grade, {money_avg_sql('loan_amount - funded_amount')} AS avg_difference
FROM {{view}} GROUP BY grade ORDER BY avg_difference DESC, grade"""

A10 = f"""
SELECT addr_state, verification_status, {money_sum_sql('loan_amount')} AS total_loan_amount
FROM {{view}} WHERE verification_status IN (:s1, :s2)
GROUP BY addr_state, verification_status ORDER BY addr_state, verification_status"""

A11 = """
WITH gaps AS (SELECT grade_encoded AS letter, date_diff(issue_date1, prev_loan_date) AS days FROM {view})
SELECT letter AS grade_encoded, avg(days) AS avg_diff FROM gaps WHERE days IS NOT NULL
GROUP BY letter ORDER BY letter"""

A12 = f"""
SELECT grade_encoded, state, {money_avg_sql('loan_amount - prev_amount_state_date')} AS loan_difference
FROM {{view}} WHERE prev_amount_state_date IS NOT NULL
GROUP BY grade_encoded, state ORDER BY grade_encoded, state"""


def register_view(df: DataFrame, prefix: str = "loans") -> str:
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def run(spark: SparkSession, template: str, view: str, **args) -> DataFrame:
    return spark.sql(template.format(view=view), args=args or None)


def analyses(spark: SparkSession, prepared_with_prev: DataFrame, approx: bool = False) -> dict[str, DataFrame]:
    """All five analyses in SQL form over one registered view."""
    v = register_view(prepared_with_prev)
    q1, q3 = an.income_range_edges(prepared_with_prev, approx)
    return {
        "a8": run(spark, A8, v, q1=q1, q3=q3, status="Default"),
        "a9": run(spark, A9, v),
        "a10": run(spark, A10, v, s1="Verified", s2="Not Verified"),
        "a11": run(spark, A11, v),
        "a12": run(spark, A12, v),
    }
