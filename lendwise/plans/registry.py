"""Registered queries: key -> (Spark callable(spark, sf_dir), oracle SQL or None).

Keys follow the inventory ids (lower case + short name). Every query reads
the driver tables (through the ``loans`` view or directly), so its work grows
with the data. Oracle SQL is DuckDB text over the same parquet tables, with
the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.plans import analytics as an
from lendwise.plans.oracle import PREP_CTES, grade_case, money_avg_sql as AVG, money_sum_sql as SUM, \
    with_loans

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Doubles rounded for the comparison of engines; operators never round."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return an.notebook_prepare(loans(spark, sf))


def with_prep(body: str, *ctes: str) -> str:
    return with_loans(body, *PREP_CTES, *ctes)


# ---------------------------------------------------------------- A: analytics
A1_BODY = f"""SELECT addr_state, CAST(year(issue_date) AS INTEGER) AS year, {AVG('annual_inc')} AS avg_annual_inc
FROM loans WHERE addr_state IS NOT NULL AND issue_date IS NOT NULL GROUP BY 1, 2"""


@register("a1_income_by_state_year", with_loans(A1_BODY))
def _a1(spark, sf):
    return an.income_by_state_year(loans(spark, sf))


@register("a2_top_state_per_year", with_loans(
    """SELECT a1.year, a1.addr_state, a1.avg_annual_inc FROM a1
JOIN (SELECT year, max(avg_annual_inc) AS m FROM a1 GROUP BY year) t
  ON a1.year = t.year AND a1.avg_annual_inc = t.m""", f"a1 AS ({A1_BODY})"))
def _a2(spark, sf):
    return an.top_income_state_per_year(loans(spark, sf))


@register("a3_income_by_year_bucket", with_loans(
    f"""SELECT CAST(floor(year(issue_date) / 1) * 1 AS INTEGER) AS year_bucket, {AVG('annual_inc')} AS avg_annual_inc
FROM loans WHERE issue_date IS NOT NULL GROUP BY 1"""))
def _a3(spark, sf):
    return an.income_by_year_bucket(loans(spark, sf), 1)


STATUSES = ["Charged Off", "Current", "Default", "Fully Paid", "Late"]


@register("a4_status_by_home_income", with_loans(
    "SELECT home_ownership, income_category, "
    + ", ".join(f"NULLIF(count(*) FILTER (WHERE loan_status = '{s}'), 0) AS \"{s}\"" for s in STATUSES)
    + """ FROM lab WHERE home_ownership IS NOT NULL AND income_category IS NOT NULL GROUP BY 1, 2""",
    "e AS (SELECT quantile_cont(annual_inc, 1/3) AS e1, quantile_cont(annual_inc, 2/3) AS e2 FROM loans)",
    """lab AS (SELECT l.*, CASE WHEN annual_inc <= (SELECT e1 FROM e) THEN 'low'
  WHEN annual_inc <= (SELECT e2 FROM e) THEN 'medium' WHEN annual_inc IS NOT NULL THEN 'high' END
  AS income_category FROM loans l)"""))
def _a4(spark, sf):
    return an.status_by_home_income(loans(spark, sf))


@register("a5_loans_by_state", with_loans(
    f"""SELECT addr_state, count(loan_id) AS loan_count, {AVG('loan_amount')} AS avg_loan_amount
FROM loans WHERE addr_state IS NOT NULL GROUP BY 1"""))
def _a5(spark, sf):
    return an.loans_by_state(loans(spark, sf))


@register("a6_income_by_title", with_loans(
    f"""SELECT emp_title, {AVG('annual_inc')} AS avg_annual_inc FROM loans
WHERE emp_title IS NOT NULL GROUP BY 1"""))
def _a6(spark, sf):
    return an.income_by_title(loans(spark, sf))


@register("a7_income_amount_by_title_home", with_loans(
    f"""SELECT emp_title, home_ownership, {AVG('annual_inc')} AS avg_annual_inc,
  {AVG('loan_amount')} AS avg_loan_amount FROM loans
WHERE emp_title IS NOT NULL AND home_ownership IS NOT NULL GROUP BY 1, 2"""))
def _a7(spark, sf):
    return an.income_amount_by_title_home(loans(spark, sf))


A8_SQL = with_prep(
    f"""SELECT emp_length,
  CASE WHEN annual_inc <= q1 THEN 'Low' WHEN annual_inc <= q3 THEN 'Mid'
       WHEN annual_inc IS NOT NULL THEN 'High' END AS income_range,
  {AVG('loan_amount')} AS avg_loan_amount, round(avg(int_rate), 9) AS avg_interest_rate
FROM prep, q WHERE loan_status = 'Default' GROUP BY 1, 2""",
    "q AS (SELECT quantile_cont(annual_inc, 0.25) AS q1, quantile_cont(annual_inc, 0.75) AS q3 FROM prep)")


@register("a8_default_by_income", A8_SQL)
def _a8(spark, sf):
    return rounded(an.default_by_income(prepared(spark, sf)), 9, "avg_interest_rate")


A9_SQL = with_loans(
    f"SELECT grade, {AVG('loan_amount - funded_amount')} AS avg_difference FROM loans GROUP BY grade")


@register("a9_avg_gap_by_grade", A9_SQL)
def _a9(spark, sf):
    return an.avg_gap_by_grade(loans(spark, sf))


A10_SQL = with_loans(
    f"""SELECT addr_state, verification_status, {SUM('loan_amount')} AS total_loan_amount FROM loans
WHERE verification_status IN ('Verified', 'Not Verified') GROUP BY 1, 2""")


@register("a10_verified_amount_by_state", A10_SQL)
def _a10(spark, sf):
    return an.verified_amount_by_state(loans(spark, sf))


LAG_CTE = """w AS (SELECT *,
  lag(issue_date1) OVER (PARTITION BY grade ORDER BY issue_date1, loan_id) AS prev_loan_date,
  lag(loan_amount) OVER (PARTITION BY grade ORDER BY issue_date1, loan_id) AS prev_loan_amount,
  lag(loan_amount) OVER (PARTITION BY state, grade ORDER BY issue_date1, loan_id) AS prev_amount_state_date,
  lag(issue_date1) OVER (PARTITION BY state, grade ORDER BY issue_date1, loan_id) AS prev_date_state_date
FROM prep)"""


A11_SQL = with_prep(
    """SELECT grade_encoded, avg(datediff('day', prev_loan_date, issue_date1)) AS avg_diff FROM w
WHERE prev_loan_date IS NOT NULL AND issue_date1 IS NOT NULL GROUP BY 1""", LAG_CTE)


@register("a11_day_gap_by_grade", A11_SQL)
def _a11(spark, sf):
    return an.day_gap_by_grade(an.previous_by_grade(prepared(spark, sf)))


A12_SQL = with_prep(
    f"""SELECT grade_encoded, state, {AVG('loan_amount - prev_amount_state_date')} AS loan_difference
FROM w WHERE prev_amount_state_date IS NOT NULL GROUP BY 1, 2""", LAG_CTE)


@register("a12_amount_change_by_grade_state", A12_SQL)
def _a12(spark, sf):
    return an.amount_change_by_grade_state(an.previous_by_state_grade(prepared(spark, sf)))


@register("w1_prev_loan_by_grade", with_prep(
    "SELECT loan_id, prev_loan_date, prev_loan_amount FROM w", LAG_CTE))
def _w1(spark, sf):
    return an.previous_by_grade(prepared(spark, sf)).select("loan_id", "prev_loan_date", "prev_loan_amount")


@register("w2_prev_loan_by_state_grade", with_prep(
    "SELECT loan_id, prev_amount_state_date, prev_date_state_date FROM w", LAG_CTE))
def _w2(spark, sf):
    return an.previous_by_state_grade(prepared(spark, sf)) \
        .select("loan_id", "prev_amount_state_date", "prev_date_state_date")


@register("a13_grade_share", with_loans(
    f"""SELECT grade_category, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM loans) * 100 AS percentage
FROM (SELECT {grade_case()} AS grade_category FROM loans) GROUP BY 1"""))
def _a13(spark, sf):
    return an.grade_share(loans(spark, sf))


def box_sql(source: str, group: str, value: str) -> str:
    lo = f"q1 - 1.5 * (q3 - q1)"
    hi = f"q3 + 1.5 * (q3 - q1)"
    g = f"{group}, " if group else ""
    using = f"JOIN q USING ({group})" if group else ", q"
    return f"""bx AS (SELECT {g}{value} FROM {source} WHERE {value} IS NOT NULL),
q AS (SELECT {g}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
  quantile_cont({value}, 0.75) AS q3 FROM bx {"GROUP BY " + group if group else ""}),
box AS (SELECT {g}round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
  round(any_value(q3), 6) AS q3,
  min(CASE WHEN {value} >= {lo} THEN {value} END) AS whisker_low,
  max(CASE WHEN {value} <= {hi} THEN {value} END) AS whisker_high,
  count(CASE WHEN {value} < {lo} OR {value} > {hi} THEN 1 END) AS n_outliers,
  round(avg({value}), 6) AS mean
FROM bx {using} {"GROUP BY " + group if group else ""})"""


@register("a14_amount_box_by_grade", with_loans(
    "SELECT * FROM box",
    f"gl AS (SELECT {grade_case()} AS grade_category, loan_amount FROM loans)",
    box_sql("gl", "grade_category", "loan_amount")))
def _a14(spark, sf):
    return rounded(an.amount_box_by_grade(loans(spark, sf)), 6, "q1", "median", "q3", "mean")


@register("a15_scatter_feed", with_loans(
    "SELECT loan_id, addr_state, annual_inc, loan_amount, loan_status FROM loans"))
def _a15(spark, sf):
    return an.scatter_feed(loans(spark, sf), "all")


@register("p11_scatter_one_state", with_loans(
    "SELECT loan_id, addr_state, annual_inc, loan_amount, loan_status FROM loans WHERE addr_state = 'NATION_7'"))
def _p11(spark, sf):
    return an.scatter_feed(loans(spark, sf), "NATION_7")


@register("a16_loans_per_month_first_year", with_loans(
    """SELECT CAST(month(issue_date) AS INTEGER) AS month, count(*) AS loan_count FROM loans
WHERE year(issue_date) = (SELECT min(year(issue_date)) FROM loans) GROUP BY 1"""))
def _a16(spark, sf):
    return an.loans_per_month(loans(spark, sf))


@register("a16b_year_options", with_loans(
    "SELECT DISTINCT CAST(year(issue_date) AS INTEGER) AS year FROM loans WHERE issue_date IS NOT NULL"))
def _a16b(spark, sf):
    return an.year_options(loans(spark, sf))


@register("a17_top5_states_by_amount", with_loans(
    f"""SELECT addr_state, {AVG('loan_amount')} AS avg_loan_amount FROM loans
WHERE addr_state IS NOT NULL GROUP BY 1 ORDER BY avg_loan_amount DESC, addr_state LIMIT 5"""))
def _a17(spark, sf):
    return an.top_states_by_amount(loans(spark, sf), 5)


PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@register("a18_income_quantiles", with_loans(" UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS quantile, round(quantile_cont(annual_inc, {p}), 6) AS value FROM loans"
    for p in PROBS)))
def _a18(spark, sf):
    return an.income_quantiles(loans(spark, sf), PROBS)


@register("a19_approx_quantile_bound", with_loans(" UNION ALL ".join(
    # An independent quantile passes its own rank test; a constant would not state one.
    f"""SELECT CAST({p} AS DOUBLE) AS quantile, avg(CAST(annual_inc < v AS INTEGER)) <= {p} + 0.01
  AND avg(CAST(annual_inc <= v AS INTEGER)) >= {p} - 0.01 AS within_bound
FROM loans, (SELECT quantile_disc(annual_inc, {p}) AS v FROM loans)"""
    for p in [0.25, 0.5, 0.75])))
def _a19(spark, sf):
    return an.approx_quantile_check(loans(spark, sf))


@register("a20_global_stats", with_loans(
    f"""SELECT count(*) AS n_rows, {AVG('annual_inc')} AS avg_annual_inc, min(annual_inc) AS min_annual_inc,
  max(annual_inc) AS max_annual_inc, {AVG('loan_amount')} AS avg_loan_amount,
  min(loan_amount) AS min_loan_amount, max(loan_amount) AS max_loan_amount FROM loans"""))
def _a20(spark, sf):
    return an.global_stats(loans(spark, sf))


@register("a21_purpose_feed", with_loans("SELECT loan_id, purpose, loan_amount, annual_inc FROM loans"))
def _a21(spark, sf):
    return an.purpose_feed(loans(spark, sf))


# Load the other query groups (they register themselves on import).
from lendwise.plans import registry_more  # noqa: E402,F401
