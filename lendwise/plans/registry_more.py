"""Registered queries: projections/features (P, E, B2), profiling (Q),
imputation (I), binning/outliers (B), encoding (N), joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendwise.fixtures import loans, raw_loans, table
from lendwise.functions import features as fx
from lendwise.operators import encode as enc
from lendwise.operators import impute as imp
from lendwise.operators import outliers as out
from lendwise.operators import profile as prof
from lendwise.operators import joins
from lendwise.operators.joins import dedupe_dim, map_values
from lendwise.plans import analytics as an
from lendwise.plans import reports
from lendwise.plans.pipeline import TYPE_CANON
from lendwise.plans.oracle import emp_length_case, grade_case, with_loans
from lendwise.plans.registry import REGISTRY, STATUSES, box_sql, register, rounded

# ------------------------------------------------------- P: projection/filter


@register("p1_normalise_names", with_loans(
    "SELECT loan_id, loan_amount, annual_inc, addr_state, issue_date FROM loans"))
def _p1(spark, sf):
    from lendwise.schema import normalise_names
    return normalise_names(raw_loans(spark, sf)).select("loan_id", "loan_amount", "annual_inc",
                                                        "addr_state", "issue_date")


@register("p2_key_uniqueness", with_loans(
    "SELECT customer_id, count(*) AS count FROM loans GROUP BY customer_id HAVING count(*) > 1"))
def _p2(spark, sf):
    from lendwise.schema import check_unique
    return check_unique(loans(spark, sf), "customer_id")


TYPE_CANON = {"INDIVIDUAL": "Individual", "JOINT": "Joint App"}


@register("p3_canonical_type", with_loans(
    "SELECT loan_id, CASE type WHEN 'INDIVIDUAL' THEN 'Individual' WHEN 'JOINT' THEN 'Joint App' "
    "ELSE type END AS type FROM loans"))
def _p3(spark, sf):
    return loans(spark, sf).replace(TYPE_CANON, subset=["type"]).select("loan_id", "type")


@register("p4_standardise_text", with_loans(
    "SELECT loan_id, replace(lower(description), ' ', '_') AS description FROM loans"))
def _p4(spark, sf):
    return loans(spark, sf).select("loan_id", fx.standardise_text("description").alias("description"))


@register("p7_filter_default", with_loans(
    "SELECT loan_id, loan_amount FROM loans WHERE loan_status = 'Default'"))
def _p7(spark, sf):
    return loans(spark, sf).where(F.col("loan_status") == "Default").select("loan_id", "loan_amount")


@register("p8_filter_isin", with_loans(
    "SELECT loan_id, verification_status FROM loans WHERE verification_status IN ('Verified', 'Not Verified')"))
def _p8(spark, sf):
    return loans(spark, sf).where(F.col("verification_status").isin("Verified", "Not Verified")) \
        .select("loan_id", "verification_status")


@register("p9_filter_null", with_loans("SELECT loan_id, loan_status FROM loans WHERE int_rate IS NULL"))
def _p9(spark, sf):
    return loans(spark, sf).where(F.col("int_rate").isNull()).select("loan_id", "loan_status")


# ------------------------------------------------------------- E: features


@register("e1_parse_date", with_loans("SELECT loan_id, issue_date AS issue_date1 FROM loans"))
def _e1(spark, sf):
    df = loans(spark, sf).select("loan_id", F.date_format("issue_date", fx.ISSUE_DATE_FORMAT).alias("s"))
    return df.select("loan_id", fx.parse_date("s").alias("issue_date1"))


@register("e2_year_month", with_loans(
    "SELECT loan_id, CAST(year(issue_date) AS INTEGER) AS year, CAST(month(issue_date) AS INTEGER) AS month, "
    "CAST(floor(year(issue_date) / 5) * 5 AS INTEGER) AS year_bucket FROM loans"))
def _e2(spark, sf):
    return loans(spark, sf).select("loan_id", F.year("issue_date").alias("year"),
                                   F.month("issue_date").alias("month"),
                                   fx.year_bucket("issue_date", 5).alias("year_bucket"))


@register("e3_salary_can_cover", with_loans(
    "SELECT loan_id, coalesce(CAST(annual_inc >= loan_amount AS INTEGER), 0) AS salary_can_cover FROM loans"))
def _e3(spark, sf):
    return loans(spark, sf).select("loan_id", fx.salary_can_cover("annual_inc", "loan_amount")
                                   .alias("salary_can_cover"))


@register("e4_loan_term", with_loans(
    "SELECT loan_id, TRY_CAST(regexp_extract(term, '([0-9]+)', 1) AS INTEGER) AS loan_term FROM loans"))
def _e4(spark, sf):
    return loans(spark, sf).select("loan_id", fx.digits_to_int("term").alias("loan_term"))


@register("e5_monthly_installment", with_loans(
    """SELECT loan_id, round(CASE WHEN pow(1 + int_rate / 12, n) - 1 = 0 THEN NULL ELSE
  loan_amount * (int_rate / 12 * pow(1 + int_rate / 12, n)) / (pow(1 + int_rate / 12, n) - 1) END, 6)
  AS monthly_installment
FROM (SELECT *, TRY_CAST(regexp_extract(term, '([0-9]+)', 1) AS INTEGER) AS n FROM loans)"""))
def _e5(spark, sf):
    df = loans(spark, sf)
    return df.select("loan_id", F.round(fx.monthly_installment("loan_amount", "int_rate",
                                                                fx.digits_to_int("term")), 6)
                     .alias("monthly_installment"))


@register("e6_pymnt_plan_int", with_loans("SELECT loan_id, CAST(pymnt_plan AS INTEGER) AS pymnt_plan FROM loans"))
def _e6(spark, sf):
    return loans(spark, sf).select("loan_id", fx.bool_to_int("pymnt_plan").alias("pymnt_plan"))


@register("e7a_emp_length_regex", with_loans(
    """SELECT loan_id, CASE WHEN contains(emp_length, '10+') THEN 11.0::DOUBLE
  WHEN contains(emp_length, '< 1') THEN 0.0::DOUBLE
  ELSE TRY_CAST(regexp_extract(emp_length, '(\\d+)', 1) AS DOUBLE) END AS emp_length_num FROM loans"""))
def _e7a(spark, sf):
    return loans(spark, sf).select("loan_id", fx.emp_length_regex("emp_length").alias("emp_length_num"))


@register("e7b_emp_length_exact", with_loans(
    f"SELECT loan_id, {emp_length_case('emp_length')} AS emp_length_num FROM loans"))
def _e7b(spark, sf):
    return loans(spark, sf).select("loan_id", fx.emp_length_exact("emp_length").alias("emp_length_num"))


@register("e8_first_token", with_loans(
    "SELECT loan_id, split_part(purpose, '_', 1) AS first_word_purpose, "
    "split_part(description, ' ', 1) AS first_word_description FROM loans"))
def _e8(spark, sf):
    return loans(spark, sf).select("loan_id", fx.first_token("purpose", "_").alias("first_word_purpose"),
                                   fx.first_token("description", " ").alias("first_word_description"))


@register("b2_grade_letter", with_loans(f"SELECT DISTINCT grade, {grade_case()} AS grade_category FROM loans"))
def _b2(spark, sf):
    return loans(spark, sf).select("grade", fx.grade_letter("grade").alias("grade_category")).distinct()


# ------------------------------------------------------------- Q: profiling
LOAN_COLS = ["loan_id", "customer_id", "issue_date", "loan_amount", "funded_amount", "annual_inc",
             "annual_inc_joint", "int_rate", "grade", "term", "emp_length", "emp_title", "home_ownership",
             "verification_status", "loan_status", "addr_state", "state", "purpose", "description", "type",
             "pymnt_plan", "avg_cur_bal", "tot_cur_bal"]
LOAN_TYPES = {"loan_id": "bigint", "customer_id": "bigint", "issue_date": "date", "grade": "bigint",
              "pymnt_plan": "boolean", "term": "string", "emp_length": "string", "emp_title": "string",
              "home_ownership": "string", "verification_status": "string", "loan_status": "string",
              "addr_state": "string", "state": "string", "purpose": "string", "description": "string",
              "type": "string"}
# Every numeric column but the key.
NUM_COLS = ["loan_id", "loan_amount", "funded_amount", "annual_inc", "annual_inc_joint", "int_rate", "grade",
            "avg_cur_bal", "tot_cur_bal"]


def _union(parts):
    return " UNION ALL ".join(parts)


@register("q1_missing_pct", with_loans(_union(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100 AS missing_pct FROM loans"
    for c in LOAN_COLS)))
def _q1(spark, sf):
    return prof.missing_pct(loans(spark, sf))


@register("q2_rate_nulls_by_status", with_loans(
    "SELECT loan_status, count(*) FILTER (WHERE int_rate IS NULL) AS missing_values, "
    "round(avg(int_rate), 6) AS mean_value FROM loans WHERE loan_status IS NOT NULL GROUP BY 1"))
def _q2(spark, sf):
    return rounded(prof.null_count_by_group(loans(spark, sf), "int_rate", "loan_status"), 6, "mean_value")


@register("q3_numeric_summary", with_loans(_union(
    f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75 FROM loans""" for c in NUM_COLS)))
def _q3(spark, sf):
    return rounded(prof.numeric_summary(loans(spark, sf), NUM_COLS), 6, "mean", "std", "q25", "q50", "q75")


DUP_COLS = ["addr_state", "grade", "loan_status", "home_ownership", "term"]


@register("q4_duplicate_rows", with_loans(
    f"""SELECT loan_id, {', '.join(DUP_COLS)} FROM (SELECT *, row_number() OVER
  (PARTITION BY {', '.join(DUP_COLS)} ORDER BY loan_id) AS rn FROM loans) WHERE rn > 1"""))
def _q4(spark, sf):
    return prof.duplicate_rows(loans(spark, sf).select("loan_id", *DUP_COLS), "loan_id")


ROW_COLS = [c for c in LOAN_COLS if c not in reports.IDS]
DUPLICATES_SQL = with_loans(f"""SELECT loan_id, {', '.join(ROW_COLS)} FROM (SELECT *, row_number() OVER
  (PARTITION BY {', '.join(ROW_COLS)} ORDER BY loan_id) AS rn FROM loans) WHERE rn > 1""")


@register("q4_duplicate_loans", with_loans(
    f"""SELECT loan_id, {', '.join(ROW_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(ROW_COLS)} ORDER BY loan_id) AS rn
  FROM (SELECT * FROM loans UNION ALL SELECT * REPLACE (loan_id + 1000000000 AS loan_id) FROM loans WHERE grade < 9)) WHERE rn > 1"""))
def _q4_loans(spark, sf):
    """Every column but the ids, over the loans and a second delivery of some of them."""
    df = loans(spark, sf)
    again = df.where("grade < 9").withColumn("loan_id", F.col("loan_id") + 1_000_000_000)
    return prof.duplicate_rows(joins.union_all([df, again]).select("loan_id", *ROW_COLS), "loan_id")


CAT_COLS = ["home_ownership", "verification_status", "loan_status", "purpose", "type"]


@register("q5_distinct_values", with_loans(_union(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM loans GROUP BY {c}"
    for c in CAT_COLS)))
def _q5(spark, sf):
    return prof.distinct_values(loans(spark, sf), CAT_COLS)


@register("q6_value_counts_emp_length", with_loans(
    "SELECT emp_length, count(*) AS count FROM loans GROUP BY emp_length"))
def _q6(spark, sf):
    return prof.value_counts(loans(spark, sf), "emp_length")


@register("q7_schema_report", with_loans(_union(
    f"SELECT '{c}' AS \"column\", '{LOAN_TYPES.get(c, 'double')}' AS type, count({c}) AS non_null FROM loans"
    for c in LOAN_COLS)))
def _q7(spark, sf):
    return prof.schema_report(loans(spark, sf))


@register("q8_min_max", with_loans(_union(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM loans"
    for c in NUM_COLS)))
def _q8(spark, sf):
    return prof.min_max(loans(spark, sf), NUM_COLS)


@register("q9_first_token_match", with_loans(
    """SELECT CAST(sum(m) AS DOUBLE) + 0.0 * count(*) AS n_matches,
  (CAST(sum(m) AS DOUBLE) + 0.0 * count(*)) / count(*) * 100 AS pct_matches
FROM (SELECT coalesce(CAST(split_part(replace(lower(description), ' ', '_'), '_', 1)
  = split_part(purpose, '_', 1) AS INTEGER), 0) AS m FROM loans)"""))
def _q9(spark, sf):
    return prof.first_token_match(loans(spark, sf), "description", "purpose")


@register("q10_spread_income", with_loans(
    """SELECT 'annual_inc' AS "column", round(quantile_cont(annual_inc, 0.25), 6) AS q_low,
  round(quantile_cont(annual_inc, 0.75), 6) AS q_high,
  round(quantile_cont(annual_inc, 0.75) - quantile_cont(annual_inc, 0.25), 6) AS spread,
  min(annual_inc) AS min, max(annual_inc) AS max FROM loans"""))
def _q10(spark, sf):
    return rounded(prof.spread_report(loans(spark, sf), "annual_inc"), 6, "q_low", "q_high", "spread")


Z_COLS = ["loan_amount", "funded_amount", "int_rate"]


@register("q11_zscore_outliers", with_loans(_union(
    f"""SELECT '{c}' AS feature, count(CASE WHEN abs(({c} - m) / s) > 3.0 THEN 1 END) AS n_outliers,
  round(max(abs(({c} - m) / s)), 6) AS max_abs_z
FROM loans, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM loans) WHERE {c} IS NOT NULL""" for c in Z_COLS)))
def _q11(spark, sf):
    return rounded(prof.zscore_outliers(loans(spark, sf), Z_COLS), 6, "max_abs_z")


@register("q12_histogram_amount", with_loans(
    """SELECT CAST(b AS INTEGER) AS bin, round(mn + (b - 1) * (mx - mn) / 10, 6) AS bin_start,
  count(loan_amount) AS count
FROM (SELECT min(loan_amount) AS mn, max(loan_amount) AS mx FROM loans) CROSS JOIN (SELECT unnest(range(1, 11)) AS b)
LEFT JOIN loans ON least(floor((loan_amount - mn) / (mx - mn) * 10) + 1, 10) = b
GROUP BY b, mn, mx"""))
def _q12(spark, sf):
    return rounded(prof.histogram(loans(spark, sf), "loan_amount", 10), 6, "bin_start")


@register("q13_kde_income", with_loans(
    """SELECT gi AS point, round(any_value(mn + gi * (mx - mn) / 63), 6) AS x,
  round(sum(w * exp(-0.5 * ((mn + gi * (mx - mn) / 63 - c) / h) * ((mn + gi * (mx - mn) / 63 - c) / h)))
    / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
FROM (SELECT fb, count(*) AS w FROM (SELECT CAST(least(floor((annual_inc - mn) / (mx - mn) * bins) + 1, bins)
        AS INTEGER) AS fb FROM loans, st WHERE annual_inc IS NOT NULL) GROUP BY fb) f,
     (SELECT mn, mx, n, bins, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st) p,
     (SELECT range AS gi FROM range(64)) g,
     LATERAL (SELECT mn + (fb - 0.5) * (mx - mn) / bins AS c)
GROUP BY gi""",
    "st AS (SELECT min(annual_inc) AS mn, max(annual_inc) AS mx, stddev_samp(annual_inc) AS sd, "
    "count(annual_inc) AS n, ceil(16 * (max(annual_inc) - min(annual_inc)) / (stddev_samp(annual_inc) "
    "* pow(CAST(count(annual_inc) AS DOUBLE), -0.2))) AS bins FROM loans)"))
def _q13(spark, sf):
    return rounded(rounded(prof.kde(loans(spark, sf), "annual_inc", 64), 6, "x"), 12, "density")


@register("q14_box_stats_amount", with_loans(
    "SELECT * FROM box",
    f"""gl AS (SELECT loan_amount FROM loans)""",
    box_sql("gl", "", "loan_amount")))
def _q14(spark, sf):
    return rounded(prof.box_stats(loans(spark, sf), "loan_amount"), 6, "q1", "median", "q3", "mean")


@register("q16_missing_flag", with_loans("SELECT loan_id, emp_title IS NULL AS emp_title_missing FROM loans"))
def _q16(spark, sf):
    return imp.missing_flag(loans(spark, sf), "emp_title").select("loan_id", "emp_title_missing")


# ----------------------------------------------------------- I: imputation


@register("i1_constant_fill", with_loans(
    "SELECT loan_id, coalesce(annual_inc_joint, 0) AS annual_inc_joint, coalesce(int_rate, 0) AS int_rate "
    "FROM loans"))
def _i1(spark, sf):
    return imp.fill_constant(loans(spark, sf), {"annual_inc_joint": 0, "int_rate": 0}) \
        .select("loan_id", "annual_inc_joint", "int_rate")


GROUP_MEAN_SQL = with_loans(
    """SELECT loan_id, round(coalesce(int_rate, gm), 9) AS rate_imputed FROM loans l
LEFT JOIN (SELECT loan_status, avg(int_rate) AS gm FROM loans WHERE loan_status IS NOT NULL GROUP BY 1) g
  ON l.loan_status IS NOT DISTINCT FROM g.loan_status""")


@register("i2_group_mean_fill", GROUP_MEAN_SQL)
def _i2(spark, sf):
    return imp.fill_group_mean(loans(spark, sf), "int_rate", "loan_status", "rate_imputed") \
        .select("loan_id", F.round("rate_imputed", 9).alias("rate_imputed"))


@register("i3_fill_from_column", with_loans(
    "SELECT loan_id, coalesce(annual_inc_joint, annual_inc) AS annual_inc_joint, "
    "coalesce(replace(lower(description), ' ', '_'), purpose) AS description FROM loans"))
def _i3(spark, sf):
    df = imp.fill_from(loans(spark, sf), "annual_inc_joint", "annual_inc")
    df = df.withColumn("description", fx.standardise_text("description"))
    return imp.fill_from(df, "description", "purpose").select("loan_id", "annual_inc_joint", "description")


@register("i4_mode_fill", with_loans(
    """SELECT loan_id, coalesce(emp_length, (SELECT emp_length FROM loans WHERE emp_length IS NOT NULL
  GROUP BY emp_length ORDER BY count(*) DESC, emp_length LIMIT 1)) AS emp_length FROM loans"""))
def _i4(spark, sf):
    return imp.fill_mode(loans(spark, sf), "emp_length").select("loan_id", "emp_length")


TERCILE_CTE = """lab AS (SELECT l.*, CASE WHEN annual_inc <= (SELECT e1 FROM e) THEN 'q1'
  WHEN annual_inc <= (SELECT e2 FROM e) THEN 'q2' WHEN annual_inc IS NOT NULL THEN 'q3' END
  AS income_category FROM loans l)"""
TERCILE_E = "e AS (SELECT quantile_cont(annual_inc, 1/3) AS e1, quantile_cont(annual_inc, 2/3) AS e2 FROM loans)"


def _terciles(df):
    return out.qcut(df, "annual_inc", 3, ["q1", "q2", "q3"], "income_category")


@register("b1_income_terciles", with_loans("SELECT loan_id, income_category FROM lab", TERCILE_E, TERCILE_CTE))
def _b1(spark, sf):
    return _terciles(loans(spark, sf)).select("loan_id", "income_category")


@register("i6_group_mode_fill", with_loans(
    """SELECT loan_id, coalesce(emp_title, gm.mode) AS emp_title FROM lab
LEFT JOIN (SELECT income_category, emp_title AS mode FROM (SELECT income_category, emp_title,
  row_number() OVER (PARTITION BY income_category ORDER BY count(*) DESC, emp_title) AS rn
  FROM lab WHERE emp_title IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) gm USING (income_category)""",
    TERCILE_E, TERCILE_CTE))
def _i6(spark, sf):
    df = _terciles(loans(spark, sf))
    return imp.fill_group_mode(df, "emp_title", "income_category").select("loan_id", "emp_title")


@register("i7_fitted_mean_fill", with_loans(
    """SELECT loan_id, round(coalesce(int_rate, (SELECT avg(coalesce(int_rate, gm)) FROM loans l
  LEFT JOIN (SELECT loan_status, avg(int_rate) AS gm FROM loans GROUP BY 1) g
  ON l.loan_status IS NOT DISTINCT FROM g.loan_status)), 9) AS rate_imputed FROM loans"""))
def _i7(spark, sf):
    from lendwise.sources.params import ParamStore
    df = loans(spark, sf)
    store = ParamStore.scratch(spark, "i7")
    filled = imp.fill_group_mean(df, "int_rate", "loan_status", "rate_imputed")
    store.save({"mean_int_rate": filled.agg(F.avg("rate_imputed")).collect()[0][0]})
    m = store.load().get("mean_int_rate")
    return df.select("loan_id", F.round(F.coalesce("int_rate", F.lit(m)), 9).alias("rate_imputed"))


# ---------------------------------------------------- B: binning / outliers


@register("b3_income_range", with_loans(
    """SELECT loan_id, CASE WHEN annual_inc <= q1 THEN 'Low' WHEN annual_inc > q1 AND annual_inc <= q3 THEN 'Mid'
  WHEN annual_inc > q3 THEN 'High' END AS income_range FROM loans,
  (SELECT quantile_cont(annual_inc, 0.25) AS q1, quantile_cont(annual_inc, 0.75) AS q3 FROM loans)"""))
def _b3(spark, sf):
    from lendwise.plans.analytics import income_range_edges, income_range_expr
    df = loans(spark, sf)
    q1, q3 = income_range_edges(df)
    return df.select("loan_id", income_range_expr(q1, q3).alias("income_range"))


LOG_SQL = """logs AS (SELECT loan_id, CASE WHEN annual_inc > 0 THEN ln(annual_inc) END AS annual_log,
  CASE WHEN annual_inc_joint > 0 THEN ln(annual_inc_joint) END AS annual_logj,
  CASE WHEN avg_cur_bal > -1 THEN ln(avg_cur_bal + 1) END AS log_avg_cur_bal,
  CASE WHEN tot_cur_bal > -1 THEN ln(tot_cur_bal + 1) END AS log_tot_cur_bal FROM loans)"""
LOG_COLS = ["annual_log", "annual_logj", "log_avg_cur_bal", "log_tot_cur_bal"]


def logs(spark, sf):
    return loans(spark, sf).select(
        "loan_id", fx.safe_ln("annual_inc").alias("annual_log"),
        fx.safe_ln("annual_inc_joint").alias("annual_logj"),
        fx.safe_ln1p("avg_cur_bal").alias("log_avg_cur_bal"),
        fx.safe_ln1p("tot_cur_bal").alias("log_tot_cur_bal"))


@register("b4_log_transforms", with_loans(
    "SELECT loan_id, " + ", ".join(f"round({c}, 9) AS {c}" for c in LOG_COLS) + " FROM logs", LOG_SQL))
def _b4(spark, sf):
    return logs(spark, sf).select("loan_id", *[F.round(c, 9).alias(c) for c in LOG_COLS])


@register("b5_iqr_fences", with_loans(_union(
    f"""SELECT '{c}' AS feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound,
  round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound FROM (SELECT quantile_cont({c}, 0.25) AS q1,
  quantile_cont({c}, 0.75) AS q3 FROM logs)""" for c in LOG_COLS), LOG_SQL))
def _b5(spark, sf):
    qs = out.fit_quantiles_multi(logs(spark, sf), LOG_COLS, [0.25, 0.75])
    rows = []
    for c in LOG_COLS:
        q1, q3 = qs[c]
        lo, hi = out.iqr_fences(q1, q3)
        rows.append((c, q1, q3, lo, hi))
    df = spark.createDataFrame(rows, "feature string, q1 double, q3 double, lower_bound double, upper_bound double")
    return df.select("feature", *[F.round(c, 6).alias(c) for c in ["q1", "q3", "lower_bound", "upper_bound"]])


def _cap_sql(col: str, lo: str | None, hi: str | None) -> str:
    e = col
    if hi and lo:
        e = f"CASE WHEN {col} > {hi} THEN {hi} WHEN {col} < {lo} THEN {lo} ELSE {col} END"
    elif lo:
        e = f"CASE WHEN {col} < {lo} THEN {lo} ELSE {col} END"
    return e


def _fences(c):
    return (f"(SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM logs)",
            f"(SELECT quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM logs)")


@register("b6_iqr_cap", with_loans(
    f"SELECT loan_id, round({_cap_sql('annual_log', *_fences('annual_log'))}, 9) AS annual_log_capped FROM logs",
    LOG_SQL))
def _b6(spark, sf):
    df = out.cap_iqr(logs(spark, sf), "annual_log", "annual_log_capped")
    return df.select("loan_id", F.round("annual_log_capped", 9).alias("annual_log_capped"))


@register("b7_percentile_cap", with_loans(
    "SELECT loan_id, round(" + _cap_sql("log_avg_cur_bal", "(SELECT quantile_cont(log_avg_cur_bal, 0.05) FROM logs)",
                                         "(SELECT quantile_cont(log_avg_cur_bal, 0.95) FROM logs)")
    + ", 9) AS avg_cur_bal_capped FROM logs", LOG_SQL))
def _b7(spark, sf):
    df = out.cap_percentiles(logs(spark, sf), "log_avg_cur_bal", "avg_cur_bal_capped")
    return df.select("loan_id", F.round("avg_cur_bal_capped", 9).alias("avg_cur_bal_capped"))


@register("b8_lower_cap", with_loans(
    f"SELECT loan_id, round({_cap_sql('log_tot_cur_bal', _fences('log_tot_cur_bal')[0], None)}, 9) "
    "AS tot_cur_bal_capped FROM logs", LOG_SQL))
def _b8(spark, sf):
    df = out.cap_lower_iqr(logs(spark, sf), "log_tot_cur_bal", "tot_cur_bal_capped")
    return df.select("loan_id", F.round("tot_cur_bal_capped", 9).alias("tot_cur_bal_capped"))


@register("b9_stored_caps", with_loans(
    f"""SELECT loan_id, round({_cap_sql('annual_log', *_fences('annual_log'))}, 9) AS annual_log_capped,
  round({_cap_sql('coalesce(annual_logj, 0)', *_fences('annual_logj'))}, 9) AS annualjoint_log_capped FROM logs""",
    LOG_SQL))
def _b9(spark, sf):
    from lendwise.sources.params import ParamStore
    df = logs(spark, sf)
    qs = out.fit_quantiles_multi(df, ["annual_log", "annual_logj"], [0.25, 0.75])
    store = ParamStore.scratch(spark, "b9")
    lo, hi = out.iqr_fences(*qs["annual_log"])
    jlo, jhi = out.iqr_fences(*qs["annual_logj"])
    store.save({"lower_bound_annual_inc": lo, "upper_bound_annual_inc": hi,
                "lower_bound_joint": jlo, "upper_bound_joint": jhi})
    p = store.load()
    return df.select(
        "loan_id",
        F.round(fx.cap("annual_log", p["lower_bound_annual_inc"], p["upper_bound_annual_inc"]), 9)
        .alias("annual_log_capped"),
        F.round(fx.cap(F.coalesce("annual_logj", F.lit(0.0)), p["lower_bound_joint"], p["upper_bound_joint"]), 9)
        .alias("annualjoint_log_capped"))


# ------------------------------------------------------------- N: encoding
HOME = ["mortgage", "none", "other", "own", "rent"]


@register("n1_onehot_home", with_loans(
    "SELECT loan_id, " + ", ".join(
        f"coalesce(CAST(lower(home_ownership) = '{v}' AS INTEGER), 0) AS home_ownership_{v}" for v in HOME)
    + " FROM loans"))
def _n1(spark, sf):
    df = loans(spark, sf).withColumn("home_ownership", F.lower("home_ownership"))
    encoded, _rows = enc.onehot(df, "home_ownership")
    return encoded.select("loan_id", *[c for c in encoded.columns if c.startswith("home_ownership_")])


@register("n1b_onehot_home_lookup", with_loans(
    """SELECT 'home_ownership' AS feature, v AS original_value, 'home_ownership_' || v AS encoded_value
FROM (SELECT DISTINCT lower(home_ownership) AS v FROM loans WHERE home_ownership IS NOT NULL)
WHERE v > (SELECT min(lower(home_ownership)) FROM loans)"""))
def _n1b(spark, sf):
    df = loans(spark, sf).withColumn("home_ownership", F.lower("home_ownership"))
    _cats, rows = enc.fit_onehot(df, "home_ownership")
    return enc.lookup_rows(spark, rows)


VERIF = ["Not Verified", "Source Verified", "Verified"]


@register("n2_onehot_verification", with_loans(
    "SELECT loan_id, " + ", ".join(
        f"coalesce(CAST(verification_status = '{v}' AS INTEGER), 0) AS \"verification_status_{v}\"" for v in VERIF)
    + " FROM loans"))
def _n2(spark, sf):
    df = loans(spark, sf)
    encoded, _rows = enc.onehot(df, "verification_status", drop_first_lookup=False)
    return encoded.select("loan_id", *[c for c in encoded.columns if c.startswith("verification_status_")])


# Fixed category list of the per-record type encoder (reference value).
TYPE_FIXED = ["joint app", "individual", "direct_pay"]


@register("n3_onehot_type_fixed", with_loans(
    "SELECT loan_id, " + ", ".join(
        f"coalesce(CAST(lower(type) = '{v}' AS INTEGER), 0) AS \"type_{v}\"" for v in TYPE_FIXED)
    + " FROM loans"))
def _n3(spark, sf):
    df = loans(spark, sf).withColumn("type", F.lower("type"))
    return df.select("loan_id", *enc.onehot_columns("type", TYPE_FIXED, "type"))


CODES_SQL = """codes AS (SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT state FROM loans WHERE state IS NOT NULL))"""


@register("n4_label_state", with_loans(
    "SELECT loan_id, code AS state_encoded FROM loans LEFT JOIN codes USING (state)", CODES_SQL))
def _n4(spark, sf):
    df, _lk = enc.label_encode(loans(spark, sf), "state")
    return df.select("loan_id", "state_encoded")


@register("n4b_label_grade_category", with_loans(
    """SELECT loan_id, CAST(dense_rank() OVER (ORDER BY grade_category) - 1 AS INTEGER) AS grade_category_encoded
FROM (SELECT loan_id, """ + grade_case() + " AS grade_category FROM loans)"))
def _n4b(spark, sf):
    df = loans(spark, sf).withColumn("grade_category", fx.grade_letter("grade"))
    df, _lk = enc.label_encode(df, "grade_category")
    return df.select("loan_id", "grade_category_encoded")


@register("n5_frequency_purpose", with_loans(
    """SELECT loan_id, CAST(code AS DOUBLE) AS purpose_encoded FROM loans LEFT JOIN
(SELECT purpose, row_number() OVER (ORDER BY n DESC, purpose) - 1 AS code
 FROM (SELECT purpose, count(*) AS n FROM loans WHERE purpose IS NOT NULL GROUP BY 1)) USING (purpose)"""))
def _n5(spark, sf):
    df = loans(spark, sf)
    codes = enc.fit_frequency_codes(df, "purpose")
    return enc.apply_codes(df, "purpose", codes, "purpose_encoded", cast="double") \
        .select("loan_id", "purpose_encoded")


@register("n6_encode_from_lookup", with_loans(
    "SELECT loan_id, CAST(code AS VARCHAR) AS state_encoded FROM loans LEFT JOIN codes USING (state)", CODES_SQL))
def _n6(spark, sf):
    df = loans(spark, sf)
    _enc_df, lookup = enc.label_encode(df, "state")
    return enc.encode_from_lookup(df, lookup, "state").select("loan_id", "state_encoded")


@register("n7_minmax_scale", with_loans(
    """SELECT loan_id, round((loan_amount - a) / (b - a) * 15.0 + 0.0, 9) AS loan_amount,
  round((funded_amount - c) / (d - c) * 15.0 + 0.0, 9) AS funded_amount FROM loans,
  (SELECT min(loan_amount) a, max(loan_amount) b, min(funded_amount) c, max(funded_amount) d FROM loans)"""))
def _n7(spark, sf):
    df = loans(spark, sf)
    ranges = enc.fit_minmax(df, ["loan_amount", "funded_amount"])
    s = enc.minmax_scale(df, ranges)
    return s.select("loan_id", *[F.round(c, 9).alias(c) for c in ["loan_amount", "funded_amount"]])


@register("n9_before_after_pairs", with_loans(
    f"SELECT DISTINCT emp_length, {emp_length_case('emp_length')} AS emp_length_imputed FROM loans"))
def _n9(spark, sf):
    df = loans(spark, sf).withColumn("emp_length_imputed", fx.emp_length_exact("emp_length"))
    return enc.before_after_pairs(df, "emp_length", "emp_length_imputed")


# ------------------------------------------------------------------ J: joins


@register("j1_state_region_map", with_loans(
    """SELECT loan_id, addr_state, r_name AS region_name FROM loans
LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) m
  ON loans.addr_state = m.n_name"""))
def _j1(spark, sf):
    dim = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = dedupe_dim(dim.select("n_name", "r_name"), "n_name", "r_name")
    return map_values(loans(spark, sf), dim, "addr_state", "n_name", "r_name", "region_name") \
        .select("loan_id", "addr_state", "region_name")




# ------------------------------------------------- keys over declared text dates, pairs, unions


def text_dated(spark, sf):
    """The loans with ``issue_date`` in its declared text form (dd MMMM yyyy)."""
    return loans(spark, sf).withColumn("issue_date", F.date_format("issue_date", "dd MMMM yyyy"))


@register("a1_text_dates", REGISTRY["a1_income_by_state_year"][1])
def _a1_text(spark, sf):
    return an.income_by_state_year(text_dated(spark, sf))


@register("a11_text_dates", REGISTRY["a11_day_gap_by_grade"][1])
def _a11_text(spark, sf):
    return an.day_gap_by_grade(an.previous_by_grade(an.notebook_prepare(text_dated(spark, sf))))


@register("q5_distinct_pairs", with_loans("SELECT home_ownership, loan_status, count(*) AS count FROM loans GROUP BY 1, 2"))
def _q5_pairs(spark, sf):
    return prof.distinct_pairs(loans(spark, sf), ["home_ownership", "loan_status"])


@register("u1_union_rows", with_loans(
    "SELECT loan_id, grade, 'low' AS part FROM loans WHERE grade <= 17 "
    "UNION ALL SELECT loan_id, grade, 'high' AS part FROM loans WHERE grade > 17"))
def _u1(spark, sf):
    df = loans(spark, sf).select("loan_id", "grade")
    return joins.union_all([df.where("grade <= 17").withColumn("part", F.lit("low")),
                            df.where("grade > 17").withColumn("part", F.lit("high"))])


@register("j3_aligned_column", with_loans(
    "SELECT loan_id, CASE WHEN annual_inc > 0 THEN round(ln(annual_inc), 9) END AS annual_log FROM loans"))
def _j3(spark, sf):
    df = loans(spark, sf)
    logs = df.select("loan_id", F.round(fx.safe_ln("annual_inc"), 9).alias("annual_log"))
    return joins.assign_aligned(df.select("loan_id"), logs, "loan_id", ["annual_log"])


# ------------------------------------------------- C5, C6: reports as one long table of counts


BOX_MEASURES = ["q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers", "mean"]


#: Reports whose values hang on the order of additions or on interpolation; all others compare exactly.
INEXACT = ["summary", "rate_nulls_by_status", "spread_income", "zscore_outliers", "histogram_income", "kde_income", "box_amount",
           "amount_box_by_grade", "grade_share"]


def rounded_reports(df):
    return df.withColumn("value", F.when(F.col("report").isin(INEXACT), F.round("value", 6)).otherwise(F.col("value")))


def long_sql(name: str, sql: str, key: list[str], measures: list[str]) -> str:
    """The SQL text of a report as rows (report, key, measure, value)."""
    joined = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '~')" for k in key) or "''"
    value = "round(CAST({m} AS DOUBLE), 6)" if name in INEXACT else "CAST({m} AS DOUBLE)"
    return " UNION ALL ".join(f"SELECT '{name}' AS report, {joined} AS key, '{m.strip(chr(34))}' AS measure, {value.format(m=m)} AS value FROM ({sql})"
                              for m in measures)


def _of(key: str) -> str:
    return REGISTRY[key][1]


@register("c5_dashboard_tables", " UNION ALL ".join([
    long_sql("grade_share", _of("a13_grade_share"), ["grade_category"], ["percentage"]),
    long_sql("amount_box_by_grade", _of("a14_amount_box_by_grade"), ["grade_category"], BOX_MEASURES),
    long_sql("scatter", _of("a15_scatter_feed"), ["loan_id", "addr_state", "loan_status"], ["annual_inc", "loan_amount"]),
    long_sql("loans_per_month", _of("a16_loans_per_month_first_year"), ["month"], ["loan_count"]),
    long_sql("year_options", "SELECT *, 1 AS offered FROM (" + _of("a16b_year_options") + ")", ["year"], ["offered"]),
    long_sql("top5_states", _of("a17_top5_states_by_amount"), ["addr_state"], ["avg_loan_amount"])]))
def _c5(spark, sf):
    """All six dashboard tables, by the letter grade."""
    df = loans(spark, sf).withColumn("grade_category", fx.grade_letter("grade"))
    return rounded_reports(reports.dashboard_long(df, "grade_category"))


INCOME_TERCILE = ("CASE WHEN annual_inc <= (SELECT quantile_cont(annual_inc, 1/3) FROM loans) THEN 'q1' "
                  "WHEN annual_inc <= (SELECT quantile_cont(annual_inc, 2/3) FROM loans) THEN 'q2' WHEN annual_inc IS NOT NULL THEN 'q3' END")
INCOME_HISTOGRAM = with_loans(
    """SELECT CAST(b AS INTEGER) AS bin, mn + (b - 1) * (mx - mn) / 30 AS bin_start, count(annual_inc) AS count
FROM (SELECT min(annual_inc) AS mn, max(annual_inc) AS mx FROM loans) CROSS JOIN (SELECT unnest(range(1, 31)) AS b)
LEFT JOIN loans ON least(floor((annual_inc - mn) / (mx - mn) * 30) + 1, 30) = b GROUP BY b, mn, mx""")
EDA_SQL = {
    "missing_pct": (_of("q1_missing_pct"), ["missing_pct"]),
    "rate_nulls_by_status": (_of("q2_rate_nulls_by_status"), ["missing_values", "mean_value"]),
    "joint_nulls_by_type": (with_loans("SELECT type, count(*) FILTER (WHERE annual_inc_joint IS NULL) AS missing_values FROM loans WHERE type IS NOT NULL GROUP BY 1"),
                            ["missing_values"]),
    "summary": (_of("q3_numeric_summary"), ["count", "mean", "std", "min", "max", "q25", "q50", "q75"]),
    "duplicates": ("SELECT *, 1 AS repeats FROM (" + DUPLICATES_SQL + ")", ["repeats"]),
    "distinct_values": (with_loans(_union(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM loans GROUP BY {c}" for c in reports.CATEGORIES)),
                        ["count"]),
    "schema": (_of("q7_schema_report"), ["non_null"]),
    "value_counts_emp_length": (_of("q6_value_counts_emp_length"), ["count"]),
    "null_counts": (with_loans(_union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM loans" for c in LOAN_COLS)), ["null_count"]),
    "emp_title_missing": (_of("q16_missing_flag"), ["emp_title_missing"]),
    "distinct_pairs": (_of("q5_distinct_pairs"), ["count"]),
    "min_max": (_of("q8_min_max"), ["min", "max"]),
    "first_token_match": (_of("q9_first_token_match"), ["n_matches", "pct_matches"]),
    "spread_income": (_of("q10_spread_income"), ["q_low", "q_high", "spread", "min", "max"]),
    "zscore_outliers": (_of("q11_zscore_outliers"), ["n_outliers", "max_abs_z"]),
    "histogram_income": (INCOME_HISTOGRAM, ["bin_start", "count"]),
    "kde_income": (_of("q13_kde_income"), ["x", "density"]),
    "box_amount": (_of("q14_box_stats_amount"), BOX_MEASURES),
    "income_by_state_year": (_of("a1_income_by_state_year"), ["avg_annual_inc"]),
    "top_income_state_per_year": (_of("a2_top_state_per_year"), ["avg_annual_inc"]),
    "income_by_year": (_of("a3_income_by_year_bucket"), ["avg_annual_inc"]),
    "status_by_home_income": (_of("a4_status_by_home_income"), [f'"{s}"' for s in STATUSES]),
    "loans_by_state": (_of("a5_loans_by_state"), ["loan_count", "avg_loan_amount"]),
    "income_by_title": (_of("a6_income_by_title"), ["avg_annual_inc"]),
    "income_amount_by_title_home": (_of("a7_income_amount_by_title_home"), ["avg_annual_inc", "avg_loan_amount"]),
    "emp_title_missing_by_income": (with_loans(f"SELECT {INCOME_TERCILE} AS income_category, count(*) FILTER (WHERE emp_title IS NULL) AS missing_values "
                                               "FROM loans WHERE annual_inc IS NOT NULL GROUP BY 1"), ["missing_values"]),
}


@register("c6_eda_report", " UNION ALL ".join(long_sql(n, sql, [f'"{k}"' for k in reports.EDA_KEYS[n]], [m if m[0] == '"' else f'"{m}"' for m in measures])
                                               for n, (sql, measures) in EDA_SQL.items()))
def _c6(spark, sf):
    """All 26 tables of the exploratory report."""
    return rounded_reports(reports.eda_long(loans(spark, sf)))


# ---------------------------------------------------------------- C3: the notebook as a job

FREQUENCY = "(SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS {c}_code FROM loans WHERE {c} IS NOT NULL GROUP BY {c})"


@register("c3_notebook_job", with_loans(
    "SELECT loan_id, CAST(state_code AS DOUBLE) AS state_encoded, CAST(purpose_code AS DOUBLE) AS purpose_encoded, "
    + ", ".join(f"coalesce(CAST(verification_status = '{v}' AS INTEGER), 0) AS \"verification_status_{v}\"" for v in VERIF)
    + ", lag(loan_id) OVER (PARTITION BY grade ORDER BY CAST(issue_date AS DATE) NULLS FIRST, loan_id) IS NOT NULL AS has_previous "
    + f"FROM loans LEFT JOIN {FREQUENCY.format(c='state')} USING (state) LEFT JOIN {FREQUENCY.format(c='purpose')} USING (purpose)"))
def _c3(spark, sf):
    cleaned, _lookup = reports.notebook_job(spark, text_dated(spark, sf))
    return cleaned.select("loan_id", "state_encoded", "purpose_encoded", *[f"verification_status_{v}" for v in VERIF],
                          F.col("prev_loan_amount").isNotNull().alias("has_previous"))


@register("c3_notebook_lookup", with_loans(
    " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS original_value, '{c}_' || {c} AS encoded_value FROM loans "
                       f"WHERE {c} IS NOT NULL" for c in reports.ONE_HOT if c != "type")
    + " UNION ALL SELECT DISTINCT 'type', t, 'type_' || t FROM (SELECT CASE type "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_CANON.items()) + " ELSE type END AS t FROM loans) WHERE t IS NOT NULL"
    + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{c}', {c}, CAST({c}_code AS VARCHAR) || '.0' FROM {FREQUENCY.format(c=c)}" for c in reports.BY_FREQUENCY)))
def _c3_lookup(spark, sf):
    return reports.notebook_job(spark, text_dated(spark, sf))[1]


from lendwise.plans import registry_io  # noqa: E402,F401
