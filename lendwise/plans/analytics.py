"""Analytic queries over a loan table (A1-A21), DataFrame form.

Each function takes a loan DataFrame and returns a DataFrame; nothing is
collected except fit parameters of bounded size (quantile edges, category
lists). Means and sums of money columns use exact DECIMAL sums
(``functions.agg``) so results do not depend on row arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lendwise.functions import features as fx
from lendwise.functions.agg import money_avg, money_sum, rate_avg
from lendwise.operators import ordered, profile
from lendwise.operators.impute import fill_constant, mode_values
from lendwise.operators.joins import rows_equal_group_max, top_n
from lendwise.operators.outliers import category_labels, fit_quantiles, qcut_expr

MAX_PIVOT_VALUES = 1000


def dated(loans: DataFrame) -> DataFrame:
    """The one date rule at the entry of every dated query: ``issue_date`` as a
    date, parsed from its declared text form (``dd MMMM yyyy``) if it is text."""
    return loans.withColumn("issue_date", fx.as_date("issue_date", loans))


# --- M1-style EDA queries (pandas semantics: null group keys dropped) --------


def income_by_state_year(loans: DataFrame) -> DataFrame:
    """A1."""
    return (dated(loans).where(F.col("addr_state").isNotNull() & F.col("issue_date").isNotNull())
            .groupBy("addr_state", F.year("issue_date").alias("year"))
            .agg(money_avg("annual_inc").alias("avg_annual_inc")))


def top_income_state_per_year(loans: DataFrame) -> DataFrame:
    """A2: A1 -> rows equal to the yearly max (ties kept)."""
    return rows_equal_group_max(income_by_state_year(loans), "year", "avg_annual_inc") \
        .select("year", "addr_state", "avg_annual_inc")


def income_by_year_bucket(loans: DataFrame, years: int = 1) -> DataFrame:
    """A3."""
    return (dated(loans).where(F.col("issue_date").isNotNull())
            .groupBy(fx.year_bucket("issue_date", years).alias("year_bucket"))
            .agg(money_avg("annual_inc").alias("avg_annual_inc")))


def status_by_home_income(loans: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """A4: loans by (home_ownership, income tercile) pivoted on loan_status.
    Absent cells are null; a listed status with no rows still gets a column."""
    edges = fit_quantiles(loans, "annual_inc", [1 / 3, 2 / 3])
    labelled = loans.withColumn("income_category",
                                qcut_expr("annual_inc", edges, ["low", "medium", "high"]))
    if statuses is None:
        statuses = category_labels(loans, "loan_status", MAX_PIVOT_VALUES)
    return (labelled.where(F.col("home_ownership").isNotNull() & F.col("income_category").isNotNull())
            .groupBy("home_ownership", "income_category")
            .pivot("loan_status", list(statuses)).count())


def loans_by_state(loans: DataFrame) -> DataFrame:
    """A5: count + mean amount per state, by count desc."""
    return (loans.where(F.col("addr_state").isNotNull()).groupBy("addr_state")
            .agg(F.count("loan_id").alias("loan_count"), money_avg("loan_amount").alias("avg_loan_amount"))
            .orderBy(F.desc("loan_count"), "addr_state"))


def income_by_title(loans: DataFrame) -> DataFrame:
    """A6."""
    return (loans.where(F.col("emp_title").isNotNull()).groupBy("emp_title")
            .agg(money_avg("annual_inc").alias("avg_annual_inc"))
            .orderBy(F.desc("avg_annual_inc"), "emp_title"))


def income_amount_by_title_home(loans: DataFrame) -> DataFrame:
    """A7."""
    return (loans.where(F.col("emp_title").isNotNull() & F.col("home_ownership").isNotNull())
            .groupBy("emp_title", "home_ownership")
            .agg(money_avg("annual_inc").alias("avg_annual_inc"),
                 money_avg("loan_amount").alias("avg_loan_amount"))
            .orderBy(F.desc("avg_annual_inc"), "emp_title", "home_ownership"))


# --- M3 notebook preparation and its five analyses ---------------------------


def notebook_prepare(loans: DataFrame, modes: dict | None = None) -> DataFrame:
    """The cleaning the M3 analyses run on: zero-fill joint income and rate,
    non-null mode fill of emp_length / emp_title / description, emp_length
    as a number (exact match), letter grade, parsed issue date."""
    cols = ["emp_length", "emp_title", "description"]
    if modes is None:
        # Lazy: each mode is a scalar subquery, evaluated once and only if
        # the query uses that column (Catalyst prunes the rest).
        fills = {c: mode_values(loans, c).select("mode").scalar() for c in cols}
    else:
        fills = {c: F.lit(modes.get(c)) for c in cols}
    df = fill_constant(loans, {"annual_inc_joint": 0.0, "int_rate": 0.0})
    df = df.withColumns({c: F.coalesce(F.col(c), fills[c]) for c in cols})
    return df.withColumns({
        "emp_length": fx.emp_length_exact("emp_length"),
        "grade_encoded": fx.grade_letter("grade"),
        "issue_date1": fx.as_date("issue_date", loans),
    })


def income_range_edges(df: DataFrame, approx: bool = False) -> tuple[float, float]:
    q = fit_quantiles(df, "annual_inc", [0.25, 0.75], approx=approx)
    return q[0], q[1]


def income_range_expr(q1: float, q3: float):
    """Low / Mid / High around the quartiles; null income -> null."""
    x = F.col("annual_inc")
    return F.when(x > q3, "High").when(x > q1, "Mid").when(x.isNotNull(), "Low")


def default_by_income(prepared: DataFrame, approx: bool = False) -> DataFrame:
    """Defaulted loans, mean amount and rate by (emp_length, income range)."""
    q1, q3 = income_range_edges(prepared, approx)
    return (prepared.withColumn("income_range", income_range_expr(q1, q3))
            .where(F.col("loan_status") == "Default")
            .groupBy("emp_length", "income_range")
            .agg(money_avg("loan_amount").alias("avg_loan_amount"),
                 rate_avg("int_rate").alias("avg_interest_rate")))


def avg_gap_by_grade(loans: DataFrame) -> DataFrame:
    """Mean (loan - funded) by grade, largest first."""
    return (loans.groupBy("grade")
            .agg(money_avg(F.col("loan_amount") - F.col("funded_amount")).alias("avg_difference"))
            .orderBy(F.desc("avg_difference"), "grade"))


def verified_amount_by_state(loans: DataFrame) -> DataFrame:
    """A10."""
    return (loans.where(F.col("verification_status").isin("Verified", "Not Verified"))
            .groupBy("addr_state", "verification_status")
            .agg(money_sum("loan_amount").alias("total_loan_amount"))
            .orderBy("addr_state", "verification_status"))


def previous_by_grade(prepared: DataFrame) -> DataFrame:
    """Previous loan date and amount of the same numeric grade, ordered by
    (issue date, loan id); skew-safe (``ordered.ordered_lag``)."""
    return ordered.ordered_lag(prepared, ["grade"], ["issue_date1", "loan_id"],
                               {"issue_date1": "prev_loan_date", "loan_amount": "prev_loan_amount"})


def previous_by_state_grade(df: DataFrame, sample_from: DataFrame | None = None) -> DataFrame:
    """The same per (state, grade)."""
    return ordered.ordered_lag(df, ["state", "grade"], ["issue_date1", "loan_id"],
                               {"loan_amount": "prev_amount_state_date",
                                "issue_date1": "prev_date_state_date"}, sample_from=sample_from)


def with_previous_loans(prepared: DataFrame) -> DataFrame:
    """W1 + W2 as columns of one table (the notebook's view). The second
    lag samples its bounds from ``prepared`` (same rows and keys) instead of
    re-running the first lag's shuffles for the sample."""
    return previous_by_state_grade(previous_by_grade(prepared), sample_from=prepared)


def day_gap_by_grade(with_prev: DataFrame) -> DataFrame:
    """Mean days between consecutive loans of a numeric grade, by letter."""
    return (with_prev.where(F.col("prev_loan_date").isNotNull() & F.col("issue_date1").isNotNull())
            .groupBy("grade_encoded")
            .agg(F.avg(F.datediff("issue_date1", "prev_loan_date")).alias("avg_diff"))
            .orderBy("grade_encoded"))


def amount_change_by_grade_state(with_prev: DataFrame) -> DataFrame:
    """Mean change vs the previous loan of the same (state, grade)."""
    return (with_prev.where(F.col("prev_amount_state_date").isNotNull())
            .groupBy("grade_encoded", "state")
            .agg(money_avg(F.col("loan_amount") - F.col("prev_amount_state_date")).alias("loan_difference"))
            .orderBy("grade_encoded", "state"))


# --- M4 dashboard feeds ------------------------------------------------------


def category_share(df: DataFrame, column: str, out: str = "percentage") -> DataFrame:
    """Share of each category in percent. The total is a plain aggregate
    over the counted categories (a scalar subquery), so no task holds them all."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.agg(F.sum("_n")).scalar()
    return counted.select(column, (F.col("_n") / total.cast("double") * 100).alias(out))


def grade_share(loans: DataFrame) -> DataFrame:
    return category_share(loans.withColumn("grade_category", fx.grade_letter("grade")), "grade_category")


def amount_box_by_grade(loans: DataFrame) -> DataFrame:
    """A14 = Q14 over (grade letter, loan_amount)."""
    return profile.box_stats(loans.withColumn("grade_category", fx.grade_letter("grade")),
                             "loan_amount", ["grade_category"])


def scatter_feed(loans: DataFrame, state: str | None = None) -> DataFrame:
    """A15 + P11: (annual_inc, loan_amount, loan_status) for one state or all."""
    df = loans if state in (None, "all") else loans.where(F.col("addr_state") == state)
    return df.select("loan_id", "addr_state", "annual_inc", "loan_amount", "loan_status")


def loans_per_month(loans: DataFrame, year: int | None = None) -> DataFrame:
    """Loans per month of ``year``; default is the first year (a scalar
    subquery, so no driver round trip)."""
    loans = dated(loans)
    y = F.lit(year) if year is not None else loans.select(F.min(F.year("issue_date"))).scalar()
    return (loans.where(F.year("issue_date") == y)
            .groupBy(F.month("issue_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("loan_count")))


def year_options(loans: DataFrame) -> DataFrame:
    """A16's year choices."""
    return dated(loans).select(F.year("issue_date").alias("year")).where(F.col("year").isNotNull()).distinct()


def top_states_by_amount(loans: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` states by mean loan amount (ties by state)."""
    agg = loans.where(F.col("addr_state").isNotNull()).groupBy("addr_state") \
        .agg(money_avg("loan_amount").alias("avg_loan_amount"))
    return top_n(agg, n, [F.desc("avg_loan_amount"), F.asc("addr_state")])


def income_quantiles(loans: DataFrame, probs=(0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Exact quantiles (distributed)."""
    q = ordered.exact_quantiles(loans, "annual_inc", probs)
    return q.select(F.col("prob").alias("quantile"), F.round("value", 6).alias("value"))


def approx_quantile_check(loans: DataFrame, probs=(0.25, 0.5, 0.75), rel_err: float = 0.01) -> DataFrame:
    """Approximate quantiles (``approxQuantile``, error 0.01) and whether
    each one's rank lies within the promised bound. One pass for the sketch,
    one aggregate for the ranks."""
    vals = loans.approxQuantile("annual_inc", list(probs), rel_err)
    x = F.col("annual_inc")
    aggs = [F.count(x).alias("_n")]
    for i, v in enumerate(vals):
        aggs += [F.count(F.when(x < v, 1)).alias(f"_lt{i}"), F.count(F.when(x <= v, 1)).alias(f"_le{i}")]
    r = loans.agg(*aggs)
    rows = []
    for i, p in enumerate(probs):
        lo = F.col(f"_lt{i}") / F.col("_n")
        hi = F.col(f"_le{i}") / F.col("_n")
        ok = (lo <= p + rel_err) & (hi >= p - rel_err)
        rows.append(F.struct(F.lit(float(p)).alias("quantile"), ok.alias("within_bound")))
    return r.select(F.explode(F.array(*rows)).alias("q")).select("q.quantile", "q.within_bound")


def global_stats(loans: DataFrame) -> DataFrame:
    """A20."""
    return loans.agg(
        F.count(F.lit(1)).alias("n_rows"),
        money_avg("annual_inc").alias("avg_annual_inc"),
        F.min("annual_inc").alias("min_annual_inc"),
        F.max("annual_inc").alias("max_annual_inc"),
        money_avg("loan_amount").alias("avg_loan_amount"),
        F.min("loan_amount").alias("min_loan_amount"),
        F.max("loan_amount").alias("max_loan_amount"),
    )


def purpose_feed(loans: DataFrame) -> DataFrame:
    """A21."""
    return loans.select("loan_id", "purpose", "loan_amount", "annual_inc")
