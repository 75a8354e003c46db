"""Registered queries: pipeline (C), lookup table (N8), streaming (T), SQL
surface (S9), sources and sinks (S)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.fixtures import loans, raw_loans, spread, table
from lendwise.plans import analytics as an
from lendwise.plans import sql as sqlf
from lendwise.plans.oracle import grade_case, with_loans
from lendwise.plans.pipeline import LoanPrep
from lendwise.plans.reports import run_etl
from lendwise.plans.registry import A8_SQL, A9_SQL, A10_SQL, A11_SQL, A12_SQL, prepared, register, rounded
from lendwise.sources import files
from lendwise.sources.html import list_links
from lendwise.streaming import stream


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ----------------------------------------------------------- C1: batch clean
_LN = "CASE WHEN {x} > 0 THEN ln({x}) END"
_LN1P = "CASE WHEN {x} > -1 THEN ln({x} + 1) END"
_JOINT = "coalesce(annual_inc_joint, annual_inc)"
_EMP = "emp_length_imputed"
_R = "(rate_imputed / 12)"
_G = f"pow(1 + {_R}, loan_term)"
HOME = ["mortgage", "none", "other", "own", "rent"]
VERIF = ["not_verified", "source_verified", "verified"]
TYPES = ["direct_pay", "individual", "joint app"]


def _codes(name: str, expr: str, src: str = "l") -> str:
    return (f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT {expr} AS v FROM {src} WHERE {expr} IS NOT NULL))")


def _cap(x: str, lo: str | None, hi: str | None) -> str:
    if lo and hi:
        return f"CASE WHEN {x} > {hi} THEN {hi} WHEN {x} < {lo} THEN {lo} ELSE {x} END"
    return f"CASE WHEN {x} < {lo} THEN {lo} ELSE {x} END"


def _fence(q1: str, q3: str, side: str) -> str:
    return f"({q1} - 1.5 * ({q3} - {q1}))" if side == "lo" else f"({q3} + 1.5 * ({q3} - {q1}))"


def clean_ctes(income_scale: str = "log") -> list[str]:
    inc = _LN.format(x="annual_inc") if income_scale == "log" else "annual_inc"
    return [c.replace("@INC@", inc) for c in _C1_CTES]


_C1_CTES = [
    """l AS (SELECT * REPLACE (CASE type WHEN 'INDIVIDUAL' THEN 'Individual' WHEN 'JOINT' THEN 'Joint App'
  ELSE type END AS type) FROM loans)""",
    "rg AS (SELECT loan_status, avg(int_rate) AS gmean FROM l WHERE loan_status IS NOT NULL GROUP BY 1)",
    f"""qs AS (SELECT quantile_cont(annual_inc, 1/3) AS t1, quantile_cont(annual_inc, 2/3) AS t2,
  quantile_cont(@INC@, 0.25) AS a1, quantile_cont(@INC@, 0.75) AS a3,
  quantile_cont({_LN.format(x=_JOINT)}, 0.25) AS j1, quantile_cont({_LN.format(x=_JOINT)}, 0.75) AS j3,
  quantile_cont({_LN1P.format(x='avg_cur_bal')}, 0.05) AS v05,
  quantile_cont({_LN1P.format(x='avg_cur_bal')}, 0.95) AS v95,
  quantile_cont({_LN1P.format(x='tot_cur_bal')}, 0.25) AS o1,
  quantile_cont({_LN1P.format(x='tot_cur_bal')}, 0.75) AS o3,
  min(loan_amount) AS la0, max(loan_amount) AS la1, min(funded_amount) AS fa0, max(funded_amount) AS fa1
  FROM l)""",
    """lab AS (SELECT l.*, CASE WHEN annual_inc <= t1 THEN 'q1' WHEN annual_inc <= t2 THEN 'q2'
  WHEN annual_inc IS NOT NULL THEN 'q3' END AS income_category FROM l, qs)""",
    """gm AS (SELECT income_category, emp_title AS gmode FROM (SELECT income_category, emp_title,
  row_number() OVER (PARTITION BY income_category ORDER BY count(*) DESC, emp_title) AS rn
  FROM lab WHERE emp_title IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)""",
    """elm AS (SELECT emp_length AS m FROM l WHERE emp_length IS NOT NULL GROUP BY 1
  ORDER BY count(*) DESC, emp_length LIMIT 1)""",
    _codes("st", "state"), _codes("ast", "addr_state"), _codes("gc", grade_case()),
    f"""b AS (SELECT lab.*, coalesce(int_rate, rg.gmean) AS rate_imputed,
  coalesce(lab.emp_title, gm.gmode) AS emp_title_f,
  coalesce(emp_length, (SELECT m FROM elm)) AS emp_length_imputed,
  TRY_CAST(regexp_extract(term, '([0-9]+)', 1) AS INTEGER) AS loan_term,
  @INC@ AS annual_log,
  coalesce({_LN.format(x=_JOINT)}, 0.0) AS annual_logj,
  {_LN1P.format(x='avg_cur_bal')} AS log_avg_cur_bal,
  {_LN1P.format(x='tot_cur_bal')} AS log_tot_cur_bal,
  {grade_case()} AS grade_category
  FROM lab LEFT JOIN rg USING (loan_status) LEFT JOIN gm USING (income_category))""",
    f"""c AS (SELECT b.*,
  {_cap('annual_log', _fence('a1', 'a3', 'lo'), _fence('a1', 'a3', 'hi'))} AS annual_log_capped,
  {_cap('annual_logj', _fence('j1', 'j3', 'lo'), _fence('j1', 'j3', 'hi'))} AS annualjoint_log_capped,
  {_cap('log_avg_cur_bal', 'v05', 'v95')} AS avg_cur_bal_capped,
  {_cap('log_tot_cur_bal', _fence('o1', 'o3', 'lo'), None)} AS tot_cur_bal_capped,
  la0, la1, fa0, fa1 FROM b, qs)""",
]

_C1_SELECT = f"""SELECT loan_id, customer_id, issue_date, @AMOUNTS@,
  round(annual_log_capped, 6) AS annual_inc, round(annualjoint_log_capped, 6) AS annual_inc_joint,
  round(rate_imputed, 6) AS int_rate, grade, loan_term AS term,
  CASE WHEN contains({_EMP}, '10+') THEN 11.0::DOUBLE WHEN contains({_EMP}, '< 1') THEN 0.0::DOUBLE
       ELSE TRY_CAST(regexp_extract({_EMP}, '(\\d+)', 1) AS DOUBLE) END AS emp_length,
  emp_title_f AS emp_title, lower(home_ownership) AS home_ownership,
  replace(lower(verification_status), ' ', '_') AS verification_status, loan_status, addr_state, state,
  purpose, coalesce(replace(lower(description), ' ', '_'), purpose) AS description, lower(type) AS type,
  CAST(pymnt_plan AS INTEGER) AS pymnt_plan, round(avg_cur_bal_capped, 6) AS avg_cur_bal,
  round(tot_cur_bal_capped, 6) AS tot_cur_bal, round(rate_imputed, 6) AS rate_imputed,
  round(annual_log, 6) AS annual_log, round(annual_logj, 6) AS annual_logj,
  round(log_avg_cur_bal, 6) AS log_avg_cur_bal, round(log_tot_cur_bal, 6) AS log_tot_cur_bal,
  round(annualjoint_log_capped, 6) AS annualjoint_log_capped, round(avg_cur_bal_capped, 6) AS avg_cur_bal_capped,
  CAST(month(issue_date) AS INTEGER) AS month,
  coalesce(CAST(annual_inc >= loan_amount AS INTEGER), 0) AS salary_can_cover, grade_category,
  round(CASE WHEN {_G} - 1 = 0 THEN NULL ELSE loan_amount * ({_R} * {_G}) / ({_G} - 1) END, 6)
    AS monthly_installment,
  {", ".join(f"coalesce(CAST(lower(home_ownership) = '{v}' AS INTEGER), 0) AS home_ownership_{v}" for v in HOME)},
  {", ".join(f"coalesce(CAST(replace(lower(verification_status), ' ', '_') = '{v}' AS INTEGER), 0) AS verification_{v}"
             for v in VERIF)},
  {", ".join(f"coalesce(CAST(lower(type) = '{v}' AS INTEGER), 0) AS \"type_{v}\"" for v in TYPES)},
  gc.code AS grade_category_encoded, st.code AS state_encoded, ast.code AS addr_state_encoded
FROM c LEFT JOIN gc ON c.grade_category = gc.v LEFT JOIN st ON c.state = st.v
LEFT JOIN ast ON c.addr_state = ast.v"""

SCALED = ("round((loan_amount - la0) / (la1 - la0) * 15.0 + 0.0, 6) AS loan_amount, "
          "round((funded_amount - fa0) / (fa1 - fa0) * 15.0 + 0.0, 6) AS funded_amount")
RAW_AMOUNTS = "round(loan_amount, 6) AS loan_amount, round(funded_amount, 6) AS funded_amount"


def clean_select(scale: bool = True) -> str:
    return _C1_SELECT.replace("@AMOUNTS@", SCALED if scale else RAW_AMOUNTS)


C1_CTES = clean_ctes("log")
C1_SELECT = clean_select(True)
C1_SQL = with_loans(C1_SELECT, *C1_CTES)
ETL_SQL = with_loans(clean_select(False), *clean_ctes("raw"))


@register("c1_clean_batch", C1_SQL)
def _c1(spark, sf):
    df = loans(spark, sf)
    model = LoanPrep().fit(df)
    return round_doubles(model.transform(df))


N8_SQL = with_loans(" UNION ALL ".join([
    "SELECT 'annual_inc_joint' AS feature, 'missing' AS original_value, 'annual_inc' AS encoded_value",
    "SELECT 'emp_length', 'missing', (SELECT m FROM elm) || '(mode)'",
    "SELECT 'home_ownership', v, 'home_ownership_' || v FROM (SELECT DISTINCT lower(home_ownership) AS v FROM l "
    "WHERE home_ownership IS NOT NULL) WHERE v > (SELECT min(lower(home_ownership)) FROM l)",
    "SELECT 'emp_length', '10+ years', '11.0'", "SELECT 'emp_length', '< 1 year', '0.0'",
    "SELECT DISTINCT 'term', term, CAST(CAST(regexp_extract(term, '([0-9]+)', 1) AS INTEGER) AS VARCHAR) FROM l "
    "WHERE regexp_extract(term, '([0-9]+)', 1) <> ''",
    "SELECT 'pymnt_plan', 'True', '1'", "SELECT 'pymnt_plan', 'False', '0'",
    "SELECT 'grade_category', v, CAST(code AS VARCHAR) FROM gc",
    "SELECT 'verification_status', v, 'verification_' || v FROM (SELECT DISTINCT replace(lower(verification_status), "
    "' ', '_') AS v FROM l WHERE verification_status IS NOT NULL) WHERE v > (SELECT min(replace(lower("
    "verification_status), ' ', '_')) FROM l)",
    "SELECT 'state', v, CAST(code AS VARCHAR) FROM st",
    "SELECT 'addr_state', v, CAST(code AS VARCHAR) FROM ast",
    "SELECT 'type', v, 'type_' || v FROM (SELECT DISTINCT lower(type) AS v FROM l WHERE type IS NOT NULL) "
    "WHERE v > (SELECT min(lower(type)) FROM l)",
]), C1_CTES[0], C1_CTES[5], C1_CTES[6], C1_CTES[7], C1_CTES[8])


@register("n8_lookup_table", N8_SQL)
def _n8(spark, sf):
    return LoanPrep().fit(loans(spark, sf)).lookup(spark)


# ------------------------------------------------------- T: streaming clean


def _messages_dir(spark, sf: str) -> str:
    """Write the loan rows as JSON messages with raw field names and the raw
    date format, then the sentinel, as the producer would send them."""
    from lendwise.functions.features import ISSUE_DATE_FORMAT
    raw = raw_loans(spark, sf)
    raw = raw.withColumn("Issue Date", F.date_format("Issue Date", ISSUE_DATE_FORMAT))
    d = files.scratch_path(spark, "messages")
    files.json_strings(raw).write.text(f"{d}/part-a")
    spark.createDataFrame([('"EOF"',)], "value string").coalesce(1).write.text(f"{d}/part-z")
    return d


def raw_name_map(spark, sf) -> dict[str, str]:
    raw = raw_loans(spark, sf).columns
    from lendwise.schema import normalise_name
    return {normalise_name(c): c for c in raw}


@register("t4_clean_stream", C1_SQL)
def _t4(spark, sf):
    model = LoanPrep().fit(loans(spark, sf))
    src = _messages_dir(spark, sf)
    schema = stream.message_schema(raw_name_map(spark, sf))
    msgs = stream.read_messages(spark, f"{src}/*")
    sink = files.scratch_path(spark, "stream-sink")
    q, flag = stream.clean_stream(spark, model, msgs, schema, sink, files.scratch_path(spark, "stream-ckpt"),
                                  trigger={"availableNow": True})
    stream.run_until_eof(q, flag)
    return round_doubles(stream.read_sink(spark, sink))


# ----------------------------------------------------------- S9: SQL surface
@register("s9_a8_sql", A8_SQL)
def _s9a8(spark, sf):
    p = prepared(spark, sf)
    q1, q3 = an.income_range_edges(p)
    return rounded(sqlf.run(spark, sqlf.A8, sqlf.register_view(p), q1=q1, q3=q3, status="Default"), 9, "avg_interest_rate")


@register("s9_a9_sql", A9_SQL)
def _s9a9(spark, sf):
    v = sqlf.register_view(loans(spark, sf))
    return sqlf.run(spark, sqlf.A9, v)


@register("s9_a10_sql", A10_SQL)
def _s9a10(spark, sf):
    v = sqlf.register_view(loans(spark, sf))
    return sqlf.run(spark, sqlf.A10, v, s1="Verified", s2="Not Verified")


@register("s9_a11_sql", A11_SQL)
def _s9a11(spark, sf):
    v = sqlf.register_view(an.previous_by_grade(prepared(spark, sf)))
    return sqlf.run(spark, sqlf.A11, v)


@register("s9_a12_sql", A12_SQL)
def _s9a12(spark, sf):
    v = sqlf.register_view(an.previous_by_state_grade(prepared(spark, sf)))
    return sqlf.run(spark, sqlf.A12, v)


# ------------------------------------------------------- S: sources / sinks
LOAN_SELECT = ("SELECT loan_id, customer_id, CAST(issue_date AS VARCHAR) AS issue_date, loan_amount, "
               "funded_amount, annual_inc, annual_inc_joint, int_rate, grade, term, emp_length, emp_title, "
               "home_ownership, verification_status, loan_status, addr_state, state, purpose, description, "
               "type, pymnt_plan, avg_cur_bal, tot_cur_bal FROM loans")


@register("s1_csv_roundtrip", with_loans(LOAN_SELECT))
def _s1(spark, sf):
    """S4 sink with raw headers -> S1 scan with the explicit schema -> P1."""
    d = files.scratch_path(spark, "csv")
    files.write_csv(raw_loans(spark, sf).withColumn("Issue Date", F.col("Issue Date").cast("string")), d)
    df = files.read_csv(spark, d)
    return df.select(*[c for c in loans(spark, sf).columns])


AWKWARD = ("CASE loan_id % 6 WHEN 0 THEN 'q\"u,o\"te' WHEN 1 THEN concat('x', chr(10), '\"y') WHEN 2 THEN '' WHEN 3 THEN NULL "
           "WHEN 4 THEN ' \\spaced, ' ELSE description END")


@register("s1_csv_awkward_text", with_loans(f"SELECT loan_id, {AWKWARD} AS description, purpose, state, loan_amount FROM loans"))
def _s1_awkward(spark, sf):
    """Quotes, commas, line breaks, empty and missing texts; two deliveries whose headers differ in order."""
    d = files.scratch_path(spark, "csv-awkward")
    df = loans(spark, sf).withColumn("description", F.expr(AWKWARD.replace("\\", "\\\\"))).select("loan_id", "description", "purpose", "state", "loan_amount")
    files.write_csv(df.where("loan_id % 2 = 0"), f"{d}/one")
    files.write_csv(df.where("loan_id % 2 = 1").select("State", "Loan_Amount", "description", "loan_id", "purpose"), f"{d}/two")
    return files.read_csv(spark, f"{d}/*").select("loan_id", "description", "purpose", "state", "loan_amount")


@register("s2_parquet_roundtrip", with_loans(LOAN_SELECT.replace("CAST(issue_date AS VARCHAR) AS issue_date",
                                                                 "issue_date")))
def _s2(spark, sf):
    """S5 sink -> S2 scan."""
    d = files.scratch_path(spark, "parquet")
    files.write_parquet(loans(spark, sf), d)
    return files.read_parquet(spark, d)


@register("s8_cached_output", A9_SQL)
def _s8(spark, sf):
    """Compute once, then reuse the stored table."""
    d = files.scratch_path(spark, "cache")
    first = files.cached_or_compute(spark, d, lambda: an.avg_gap_by_grade(loans(spark, sf)))
    first.count()
    return files.cached_or_compute(spark, d, lambda: (_ for _ in ()).throw(RuntimeError("recomputed")))


# Cut at the end tags, then at the last start tag before each: no pattern of the operator's.
@register("s10_html_links", """SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos,
  split_part(split_part(a, 'href="', 2), '"', 1) AS href, trim(substr(a, position('>' IN a) + 1)) AS text
FROM (SELECT page_id, i, list_extract(string_split(piece, '<a '), -1) AS a FROM (
  SELECT page_id, unnest(string_split(html, '</a>')) AS piece, generate_subscripts(string_split(html, '</a>'), 1) AS i FROM pages)
  WHERE contains(piece, '<a '))""")
def _s10(spark, sf):
    return list_links(spread(table(spark, sf, "pages")))


@register("s11_preview", with_loans(
    "SELECT loan_id, loan_amount, issue_date, grade FROM loans ORDER BY loan_id LIMIT 20"))
def _s11(spark, sf):
    return files.preview(loans(spark, sf).select("loan_id", "loan_amount", "issue_date", "grade"), ["loan_id"], 20)


# ------------------------------------------- C4 / T6 / Q15 / S12 compositions


@register("c4_etl_pipeline", ETL_SQL)
def _c4(spark, sf):
    """extract_clean -> transform -> load, each stage a Parquet table."""
    paths = run_etl(spark, loans(spark, sf))
    return round_doubles(spark.read.parquet(paths.loaded))


@register("t6_batch_then_stream", with_loans(C1_SELECT + "\nUNION ALL\n" + C1_SELECT, *C1_CTES))
def _t6(spark, sf):
    """Batch-clean the table first, then stream the producer's messages into
    the same table."""
    df = loans(spark, sf)
    model = LoanPrep().fit(df)
    src = _messages_dir(spark, sf)
    schema = stream.message_schema(raw_name_map(spark, sf))
    sink = files.scratch_path(spark, "t6-sink")
    out = stream.load_batch_then_stream(spark, model, df, stream.read_messages(spark, f"{src}/*"), schema,
                                        sink, files.scratch_path(spark, "t6-ckpt"), {"availableNow": True})
    return round_doubles(out)


IMPUTED = ["int_rate", "emp_title", "emp_length", "description", "annual_inc_joint"]


@register("q15_post_impute_check", with_loans(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM cleaned"
    for c in IMPUTED), *C1_CTES, f"cleaned AS ({C1_SELECT})"))
def _q15(spark, sf):
    from lendwise.operators.profile import null_counts
    df = loans(spark, sf)
    return null_counts(LoanPrep().fit(df).transform(df), IMPUTED)


@register("s12_coalesced_lookup", N8_SQL)
def _s12(spark, sf):
    """Lookup coalesced to one partition before the write (the only place a
    single partition is wanted), read back."""
    lk = files.with_partitions(LoanPrep().fit(loans(spark, sf)).lookup(spark), coalesce_to=1)
    d = files.scratch_path(spark, "lookup")
    files.write_parquet(lk, d)
    return files.read_parquet(spark, d)
