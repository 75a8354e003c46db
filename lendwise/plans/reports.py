"""Composite jobs: the notebook (C3), the ETL stages (C4), dashboard tables (C5), EDA report.

The ETL job is one Spark application with callable stages. Stage outputs
are Parquet tables in a shared folder (under ``spark.checkpoint.dir`` unless
given), so types survive the hand-over, each stage can be rerun alone, and
the written tables cut the lineage between stages - a lost executor never
forces a recompute from the raw input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.operators import encode as enc
from lendwise.operators import profile as prof
from lendwise.operators.impute import missing_flag
from lendwise.operators.joins import rows_equal_group_max, top_n, union_all
from lendwise.operators.outliers import iqr_fences
from lendwise.plans import analytics as an
from lendwise.plans import fused
from lendwise.plans.fused import Keyed
from lendwise.plans.pipeline import ETL_CONFIG, TYPE_CANON, LoanPrep, LoanPrepConfig, LoanPrepModel
from lendwise.schema import nan_to_null
from lendwise.sources import files
from lendwise.sources.params import ParamStore


@dataclass
class EtlPaths:
    base: str

    @property
    def params(self) -> str:
        return f"{self.base}/params"

    @property
    def clean(self) -> str:
        return f"{self.base}/clean"

    @property
    def transformed(self) -> str:
        return f"{self.base}/transformed"

    @property
    def lookup(self) -> str:
        return f"{self.base}/lookup"

    @property
    def loaded(self) -> str:
        return f"{self.base}/loans_clean"


def extract_clean(spark: SparkSession, raw: DataFrame, paths: EtlPaths,
                  config: LoanPrepConfig = ETL_CONFIG) -> LoanPrepModel:
    """Stage 1: fit, store parameters and lookup, write the cleaned table."""
    model = LoanPrep(config).fit(raw)
    model.save(ParamStore(spark, paths.params))
    model.lookup(spark).coalesce(1).write.mode("overwrite").parquet(paths.lookup)
    model.transform_clean(raw).write.mode("overwrite").parquet(paths.clean)
    return model


def transform(spark: SparkSession, paths: EtlPaths) -> None:
    """Stage 2: features and encodings from the stored parameters."""
    model = LoanPrepModel.load(ParamStore(spark, paths.params))
    cleaned = spark.read.parquet(paths.clean)
    model.transform_features(cleaned).write.mode("overwrite").parquet(paths.transformed)


def load(spark: SparkSession, paths: EtlPaths, jdbc_url: str | None = None,
         table: str = "loans_clean", properties: dict | None = None) -> None:
    """Stage 3: replace the serving table (JDBC when a URL is given, else a
    Parquet table next to the stages)."""
    df = spark.read.parquet(paths.transformed)
    if jdbc_url:
        files.write_jdbc(df, jdbc_url, table, mode="overwrite", properties=properties)
    else:
        df.write.mode("overwrite").parquet(paths.loaded)


def run_etl(spark: SparkSession, raw: DataFrame, base: str | None = None,
            config: LoanPrepConfig = ETL_CONFIG) -> EtlPaths:
    paths = EtlPaths(base or files.scratch_path(spark, "etl"))
    extract_clean(spark, raw, paths, config)
    transform(spark, paths)
    load(spark, paths)
    return paths


ONE_HOT = ("home_ownership", "verification_status", "type")
BY_FREQUENCY = ("state", "purpose")


def notebook_job(spark: SparkSession, loans: DataFrame, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """C3 as a job: the notebook's cleaning, three one-hots, two frequency
    indexes and previous-loan columns; the cleaned table and the lookup table are
    written under ``base`` and returned as read back."""
    base = base or files.scratch_path(spark, "notebook")
    loans = loans.replace(TYPE_CANON, subset=["type"])  # spellings that differ in case only would clash as column names
    df, rows, tables = an.with_previous_loans(an.notebook_prepare(loans)), [], []
    for column in ONE_HOT:
        df, logged = enc.onehot(df, column, drop_first_lookup=False)
        rows += logged
    for column in BY_FREQUENCY:
        codes = enc.fit_frequency_codes(loans, column)
        df = enc.apply_codes(df, column, codes, f"{column}_encoded", cast="double")
        tables.append(codes.select(F.lit(column).alias("feature"), F.col(column).alias("original_value"),
                                   F.col("code").cast("double").cast("string").alias("encoded_value")))
    files.write_parquet(df, f"{base}/cleaned")
    files.write_parquet(union_all([enc.lookup_rows(spark, rows), *tables]).coalesce(1), f"{base}/lookup")
    return files.read_parquet(spark, f"{base}/cleaned"), files.read_parquet(spark, f"{base}/lookup")


class Frames(Mapping):
    """Named DataFrames, each built when asked for (some start jobs for their
    parameters), and once."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def dashboard_tables(transformed: DataFrame, state: str | None = None,
                     year: int | None = None, grade: str = "grade_category_encoded") -> "Frames":
    """The data behind the five dashboard charts (A13-A17): counts, shares and means from one
    read, the box plot's quantiles and whiskers from three, the scatter rows as they are."""
    df = nan_to_null(an.dated(transformed))
    kind = dict(df.dtypes)[grade]
    counts = cached(lambda: fused.keyed_pass(df, [
        Keyed("grade", (grade,)), Keyed("month", ("year(issue_date)", "month(issue_date)"), where="issue_date IS NOT NULL"),
        Keyed("state", ("addr_state",), x="loan_amount", where="addr_state IS NOT NULL", sums="x")]))

    def share() -> DataFrame:
        rows = counts().of("grade", {grade: kind}, _n="n")
        total = rows.agg(F.sum("_n")).scalar()
        return rows.select(grade, (F.col("_n") / total.cast("double") * 100).alias("percentage"))

    def months() -> DataFrame:
        rows = counts().of("month", {"year": "INT", "month": "INT"}, loan_count="n")
        chosen = F.lit(year) if year is not None else rows.select(F.min("year")).scalar()
        return rows.where(F.col("year") == chosen).select("month", "loan_count")

    states = lambda: counts().of("state", {"addr_state": "STRING"}, avg_loan_amount=fused.MONEY_AVG.format("x"))
    return Frames({
        "grade_share": share,
        "amount_box_by_grade": lambda: prof.box_stats(df, "loan_amount", [grade]),
        "scatter": lambda: an.scatter_feed(transformed, state),
        "loans_per_month": months,
        "year_options": lambda: counts().of("month", {"year": "INT"}).distinct(),
        "top5_states": lambda: top_n(states(), 5, [F.desc("avg_loan_amount"), F.asc("addr_state")]),
    })


DASHBOARD_KEYS = {"grade_share": ["{grade}"], "amount_box_by_grade": ["{grade}"], "scatter": ["loan_id", "addr_state", "loan_status"],
                  "loans_per_month": ["month"], "year_options": ["year"], "top5_states": ["addr_state"]}


def dashboard_long(transformed: DataFrame, grade: str = "grade_category_encoded") -> DataFrame:
    """All dashboard tables as rows (report, key, measure, value); the year choices have a measure of 1."""
    frames = dashboard_tables(transformed, grade=grade)
    whole = {n: frames[n] for n in frames} | {"year_options": frames["year_options"].withColumn("offered", F.lit(1))}
    return fused.long_table(whole, {n: [k.format(grade=grade) for k in ks] for n, ks in DASHBOARD_KEYS.items()})


CATEGORIES = ["home_ownership", "verification_status", "loan_status", "grade", "purpose", "type"]
#: The key is no measure; copies of a row are looked for whatever their ids.
KEY, IDS = ("customer_id",), ("loan_id", "customer_id")
Z_COLUMNS = ("loan_amount", "funded_amount", "int_rate")
LEVELS = {"q1": "low", "q2": "medium", "q3": "high"}
HISTOGRAM_BINS, DENSITY_POINTS = 30, 64


def cached(make: Callable):
    """``make`` called when first needed, and once."""
    held = []

    def get():
        if not held:
            held.append(make())
        return held[0]

    return get


def eda_report(loans: DataFrame) -> "Frames":
    """The exploratory report (Q1-Q16, A1-A7) as named DataFrames, from five reads of the input in
    all: facts per column, keyed reports, two for all quantiles, reports that need
    those; duplicates and the missing flags, which are rows of the input, read it themselves."""
    df = nan_to_null(an.dated(loans))
    spark, numeric = df.sparkSession, fused.numeric_columns(df, KEY)
    facts = cached(lambda: fused.column_facts(df))
    probs = [0.25, 1 / 3, 0.5, 2 / 3, 0.75]
    quantiles = cached(lambda: fused.quantile_facts(df, numeric, probs))
    avg = fused.MONEY_AVG.format
    title, state, home = "emp_title IS NOT NULL", "addr_state IS NOT NULL", "home_ownership IS NOT NULL"
    a, b = "split_part(replace(lower(description), ' ', '_'), '_', 1)", "split_part(purpose, '_', 1)"
    keyed = cached(lambda: fused.keyed_pass(df, [
        Keyed("rate_nulls", ("loan_status",), x="int_rate", where="loan_status IS NOT NULL"),
        Keyed("joint_nulls", ("type",), x="annual_inc_joint", where="type IS NOT NULL"),
        *[Keyed(f"values_{c}", (c,)) for c in CATEGORIES],
        Keyed("emp_length", ("emp_length",)),
        Keyed("pairs", ("home_ownership", "loan_status")),
        Keyed("tokens", (), x=f"coalesce(CAST({a} = {b} AS INT), 0)", sums="x"),
        Keyed("state_year", ("addr_state", "year(issue_date)"), x="annual_inc", where=f"{state} AND issue_date IS NOT NULL", sums="x"),
        Keyed("year", ("year(issue_date)",), x="annual_inc", where="issue_date IS NOT NULL", sums="x"),
        Keyed("state", ("addr_state",), x="loan_amount", y="loan_id", where=state, sums="x"),
        Keyed("title", ("emp_title",), x="annual_inc", where=title, sums="x"),
        Keyed("title_home", ("emp_title", "home_ownership"), x="annual_inc", y="loan_amount", where=f"{title} AND {home}", sums="xy"),
    ]))

    def second() -> fused.KeyedTable:
        """Reports that need facts and quantiles."""
        f, q = facts(), quantiles()
        reports = []
        for c in Z_COLUMNS:
            z = f"abs(({c} - {_number(f[c]['mean'])}) / nullif({_number(f[c]['std'])}, 0D))"
            reports.append(Keyed(f"z_{c}", (), x=z, y=f"CASE WHEN {z} > 3 THEN 1 END"))
        mn, mx, inc = _number(f["annual_inc"]["min"]), _number(f["annual_inc"]["max"]), "annual_inc IS NOT NULL"
        bins = lambda n: f"CASE WHEN {mx} = {mn} THEN 1 ELSE least(floor((annual_inc - {mn}) / nullif({mx} - {mn}, 0D) * {n}) + 1, {n}) END"
        reports += [Keyed("histogram", (bins(HISTOGRAM_BINS),), where=inc)]
        fine = prof.density_bins(f["annual_inc"]["min"], f["annual_inc"]["max"], f["annual_inc"]["std"], f["annual_inc"]["values"])
        if fine:
            reports.append(Keyed("density", (bins(fine),), where=inc))
        lo, hi = (_number(x) for x in iqr_fences(q["loan_amount"][0], q["loan_amount"][4]))
        reports += [Keyed("box_low", (), x=f"CASE WHEN loan_amount >= {lo} THEN loan_amount END"),
                    Keyed("box_high", (), x=f"CASE WHEN loan_amount <= {hi} THEN loan_amount END", y=f"CASE WHEN loan_amount < {lo} OR loan_amount > {hi} THEN 1 END")]
        e1, e2 = (_number(q["annual_inc"][i]) for i in (1, 3))
        tercile = f"CASE WHEN annual_inc <= {e1} THEN 'q1' WHEN annual_inc <= {e2} THEN 'q2' WHEN annual_inc IS NOT NULL THEN 'q3' END"
        reports += [Keyed("home_income", ("home_ownership", tercile, "loan_status"), where=f"{home} AND {inc}"),
                    Keyed("title_income", (tercile,), x=f"CASE WHEN {title} THEN 1 END", where=inc)]
        return fused.keyed_pass(df, reports)

    second = cached(second)
    local = lambda rows, schema: spark.createDataFrame(rows, schema)

    def outliers() -> DataFrame:
        parts = [second().of(f"z_{c}", feature=f"'{c}'", n_outliers="y_n", max_abs_z="x_max") for c in Z_COLUMNS]
        return union_all(parts)

    def histogram() -> DataFrame:
        f = facts()["annual_inc"]
        every = spark.range(1, HISTOGRAM_BINS + 1).select(F.col("id").cast("int").alias("bin"))
        rows = every.join(second().of("histogram", {"bin": "INT"}, count="n"), "bin", "left").fillna(0, ["count"])
        return rows.select("bin", (F.lit(f["min"]) + (F.col("bin") - 1) * ((f["max"] or 0) - (f["min"] or 0)) / HISTOGRAM_BINS).alias("bin_start"), "count")

    def density() -> DataFrame:
        f = facts()["annual_inc"]
        if not prof.density_bins(f["min"], f["max"], f["std"], f["values"]):
            return local([], "point int, x double, density double")
        return prof.density_curve(second().of("density", {"fb": "INT"}, w="n"), f["min"], f["max"], f["std"], f["values"], DENSITY_POINTS)

    def box() -> DataFrame:
        q, low, high = quantiles()["loan_amount"], second().of("box_low", whisker_low="x_min").first(), second().of("box_high", whisker_high="x_max", n="y_n").first()
        if q[0] is None:
            return local([], BOX)
        return local([(q[0], q[2], q[4], low["whisker_low"], high["whisker_high"], high["n"], facts()["loan_amount"]["mean"])], BOX)

    def statuses() -> DataFrame:
        rows = second().of("home_income", {"home_ownership": "STRING", "income_category": "STRING", "loan_status": "STRING"}, n="n")
        level = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])[F.col("income_category")]
        rows = rows.withColumn("income_category", level)
        names = sorted(r[0] for r in rows.where("loan_status IS NOT NULL").select("loan_status").distinct().limit(an.MAX_PIVOT_VALUES + 1).collect())
        if len(names) > an.MAX_PIVOT_VALUES:
            raise ValueError(f"loan_status has more than {an.MAX_PIVOT_VALUES} distinct values")
        return rows.groupBy("home_ownership", "income_category").pivot("loan_status", names).agg(F.sum("n"))

    def summary() -> DataFrame:
        f, q = facts(), quantiles()
        return local([(c, f[c]["values"], f[c]["mean"], f[c]["std"], f[c]["min"], f[c]["max"], q[c][0], q[c][2], q[c][4]) for c in numeric],
                     "feature string, count long, mean double, std double, min double, max double, q25 double, q50 double, q75 double")

    def spread() -> DataFrame:
        f, q = facts()["annual_inc"], quantiles()["annual_inc"]
        return local([("annual_inc", q[0], q[4], None if q[0] is None else q[4] - q[0], f["min"], f["max"])],
                     "column string, q_low double, q_high double, spread double, min double, max double")

    years = lambda: keyed().of("state_year", {"addr_state": "STRING", "year": "INT"}, avg_annual_inc=avg("x"))
    per_column = lambda schema, row: local([(c, *row(facts()[c], c)) for c in df.columns], f"column string, {schema}")
    types = dict(loans.dtypes)
    return Frames({
        "missing_pct": lambda: per_column("missing_pct double", lambda f, c: ((f["rows"] - f["values"]) / f["rows"] * 100 if f["rows"] else None,)),
        "rate_nulls_by_status": lambda: keyed().of("rate_nulls", {"loan_status": "STRING"}, missing_values="n - x_n", mean_value="x_avg"),
        "joint_nulls_by_type": lambda: keyed().of("joint_nulls", {"type": "STRING"}, missing_values="n - x_n"),
        "summary": summary,
        "duplicates": lambda: prof.duplicate_rows(loans, "loan_id", [c for c in loans.columns if c not in IDS]),
        "distinct_values": lambda: union_all([keyed().of(f"values_{c}", {"value": "STRING"}, feature=f"'{c}'", count="n").select("feature", "value", "count")
                                              for c in CATEGORIES]),
        "schema": lambda: per_column("type string, non_null long", lambda f, c: (types[c], f["values"])),
        "value_counts_emp_length": lambda: keyed().of("emp_length", {"emp_length": "STRING"}, count="n"),
        "null_counts": lambda: per_column("null_count long", lambda f, c: (f["rows"] - f["values"],)),
        "emp_title_missing": lambda: missing_flag(loans, "emp_title").select("loan_id", "emp_title_missing"),
        "distinct_pairs": lambda: keyed().of("pairs", {"home_ownership": "STRING", "loan_status": "STRING"}, count="n"),
        "min_max": lambda: local([(c, facts()[c]["min"], facts()[c]["max"]) for c in numeric], "column string, min double, max double"),
        "first_token_match": lambda: keyed().of("tokens", n_matches="x_sum", pct_matches="x_sum / n * 100"),
        "spread_income": spread,
        "zscore_outliers": outliers,
        "histogram_income": histogram,
        "kde_income": density,
        "box_amount": box,
        "income_by_state_year": years,
        "top_income_state_per_year": lambda: rows_equal_group_max(years(), "year", "avg_annual_inc").select("year", "addr_state", "avg_annual_inc"),
        "income_by_year": lambda: keyed().of("year", {"year_bucket": "INT"}, avg_annual_inc=avg("x")),
        "status_by_home_income": statuses,
        "loans_by_state": lambda: keyed().of("state", {"addr_state": "STRING"}, loan_count="y_n", avg_loan_amount=avg("x")).orderBy(F.desc("loan_count"), "addr_state"),
        "income_by_title": lambda: keyed().of("title", {"emp_title": "STRING"}, avg_annual_inc=avg("x")).orderBy(F.desc("avg_annual_inc"), "emp_title"),
        "income_amount_by_title_home": lambda: keyed().of("title_home", {"emp_title": "STRING", "home_ownership": "STRING"}, avg_annual_inc=avg("x"),
                                                          avg_loan_amount=avg("y")).orderBy(F.desc("avg_annual_inc"), "emp_title", "home_ownership"),
        "emp_title_missing_by_income": lambda: second().of("title_income", {"income_category": "STRING"}, missing_values="n - x_n"),
    })


BOX = "q1 double, median double, q3 double, whisker_low double, whisker_high double, n_outliers long, mean double"
#: Key columns of each report in the long table; the others are measures.
EDA_KEYS = {
    "missing_pct": ["column"], "rate_nulls_by_status": ["loan_status"], "joint_nulls_by_type": ["type"], "summary": ["feature"], "duplicates": ["loan_id"],
    "distinct_values": ["feature", "value"], "schema": ["column", "type"], "value_counts_emp_length": ["emp_length"], "null_counts": ["column"],
    "emp_title_missing": ["loan_id"], "distinct_pairs": ["home_ownership", "loan_status"], "min_max": ["column"], "first_token_match": [],
    "spread_income": ["column"], "zscore_outliers": ["feature"], "histogram_income": ["bin"], "kde_income": ["point"], "box_amount": [],
    "income_by_state_year": ["addr_state", "year"], "top_income_state_per_year": ["year", "addr_state"], "income_by_year": ["year_bucket"],
    "status_by_home_income": ["home_ownership", "income_category"], "loans_by_state": ["addr_state"], "income_by_title": ["emp_title"],
    "income_amount_by_title_home": ["emp_title", "home_ownership"], "emp_title_missing_by_income": ["income_category"]}


def eda_long(loans: DataFrame) -> DataFrame:
    """All tables of the report as rows (report, key, measure, value); of a duplicate row its key and a measure of 1."""
    frames = eda_report(loans)
    whole = {n: frames[n] for n in frames} | {"duplicates": frames["duplicates"].select("loan_id", F.lit(1).alias("repeats"))}
    return fused.long_table(whole, EDA_KEYS)


def _number(x) -> str:
    """A Python float as exact SQL text."""
    return "CAST(NULL AS DOUBLE)" if x is None else f"{float(x)!r}D"
