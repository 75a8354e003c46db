"""SQL text fragments shared by the oracle queries (DuckDB dialect).

Built from the same fixed values as the Spark expressions, so the two sides
cannot drift apart.
"""

from __future__ import annotations

from lendwise.fixtures import with_loans
from lendwise.functions.agg import money_avg_sql, money_sum_sql
from lendwise.functions.features import EMP_LENGTH_EXACT, GRADE_RANGES, GRADE_UNKNOWN

__all__ = ["with_loans", "money_avg_sql", "money_sum_sql", "grade_case", "emp_length_case",
           "PREP_CTES", "modes_cte"]


def grade_case(col: str = "grade") -> str:
    arms = " ".join(f"WHEN {col} BETWEEN {lo} AND {hi} THEN '{g}'" for g, lo, hi in GRADE_RANGES)
    return f"CASE {arms} ELSE '{GRADE_UNKNOWN}' END"


def emp_length_case(expr: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EMP_LENGTH_EXACT.items())
    return f"CASE lower(trim({expr})) {arms} ELSE NULL END"


def modes_cte(name: str, source: str, columns: list[str]) -> str:
    """Non-null mode per column, ties -> smallest value."""
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)
    return (f"{name} AS (SELECT feature, value AS mode FROM (SELECT feature, value, "
            f"row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM ({parts})) "
            f"WHERE rn = 1)")


def _mode(feature: str) -> str:
    return f"(SELECT mode FROM modes WHERE feature = '{feature}')"


# The M3 notebook preparation (see plans.analytics.notebook_prepare).
PREP_CTES = [
    modes_cte("modes", "loans", ["emp_length", "emp_title", "description"]),
    f"""prep AS (
  SELECT loan_id, customer_id, issue_date, CAST(issue_date AS DATE) AS issue_date1, loan_amount,
    funded_amount, annual_inc, coalesce(annual_inc_joint, 0) AS annual_inc_joint,
    coalesce(int_rate, 0) AS int_rate, grade, term,
    {emp_length_case("coalesce(emp_length, " + _mode("emp_length") + ")")} AS emp_length,
    coalesce(emp_title, {_mode("emp_title")}) AS emp_title,
    coalesce(description, {_mode("description")}) AS description,
    home_ownership, verification_status, loan_status, addr_state, state, purpose, type,
    pymnt_plan, avg_cur_bal, tot_cur_bal,
    {grade_case()} AS grade_encoded
  FROM loans)""",
]
