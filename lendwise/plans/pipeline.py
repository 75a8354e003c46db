"""Loan cleaning pipeline (C1-C3): ``LoanPrep(config).fit(df) -> LoanPrepModel``.

``model.transform(df)`` is made only of Column expressions with the fitted
parameters as literals (group means, group modes, caps, category lists, code
maps), so the very same transform serves a batch DataFrame and a Structured
Streaming one - a single record is never re-fitted. ``model.lookup(spark)``
returns the lookup table (feature, original_value, encoded_value).

A fit is a set of parts that merge (``fit_state``): each batch of input is read twice, by different
columns (counts per value; the few numeric columns projected), and what
follows reads the small tables of the shared folder: two reads of the counts, one distributed
selection over all numeric features at once (or one sketch pass with ``approx=True``), and the
titles per income tercile. Nothing is persisted on executors. Every
collected parameter has a size bound that is checked (category lists), never silently capped.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.functions import features as fx
from lendwise.operators import encode as enc
from lendwise.plans.fit_state import FitState
from lendwise.schema import normalise_names

# Canonical spellings of the loan type (fixed values of the reference).
TYPE_CANON = {"INDIVIDUAL": "Individual", "JOINT": "Joint App"}
FIT_COLUMNS = ["loan_status", "int_rate", "loan_amount", "funded_amount", "home_ownership",
               "verification_status", "type", "state", "addr_state", "term", "grade", "emp_length",
               "emp_title", "annual_inc", "annual_inc_joint", "avg_cur_bal", "tot_cur_bal"]
DROPPED = ["income_category", "emp_length_imputed", "annual_log_capped", "annual_inc_joint_handled",
           "avg_cur_bal_handled", "tot_cur_bal_capped", "loan_term"]


@dataclass
class LoanPrepConfig:
    income_scale: str = "log"          # "log" (packaged app) or "raw" (ETL variant: caps raw income)
    joint_fill: str = "income"         # "income": joint <- annual_inc; "zero": joint <- 0
    rate_fill: str = "group_mean"      # "group_mean" by loan_status, or "zero"
    scale: bool = True                 # min-max scale loan/funded amount (off in the ETL variant)
    feature_range: tuple = (0.0, 15.0)
    approx: bool = False               # sketch quantiles (bounded memory) instead of exact
    max_categories: int = 10_000       # bound on every collected category list


@dataclass
class LoanPrepModel:
    config: LoanPrepConfig
    params: dict = field(default_factory=dict)

    # -------------------------------------------------------------- transform
    def transform(self, df: DataFrame) -> DataFrame:
        return self.transform_features(self.transform_clean(df))

    def transform_clean(self, df: DataFrame) -> DataFrame:
        """Stage 1: names, canonical values, missing values, outlier caps."""
        p, cfg = self.params, self.config
        if any(c != c.lower() or " " in c for c in df.columns):
            df = normalise_names(df)
        df = df.replace(TYPE_CANON, subset=["type"])
        # -- missing values
        rate_map = _map(p["rate_group_means"])
        if cfg.rate_fill == "group_mean":
            rate_fill = F.coalesce(rate_map[F.col("loan_status")], F.lit(p["mean_int_rate"]))
        else:
            rate_fill = F.lit(0.0)
        joint_fill = F.col("annual_inc") if cfg.joint_fill == "income" else F.lit(0.0)
        inc = F.col("annual_inc")
        cats = F.when(inc <= p["income_terciles"][0], "q1").when(inc <= p["income_terciles"][1], "q2") \
                .when(inc.isNotNull(), "q3")
        df = df.withColumns({
            "rate_imputed": F.coalesce(F.col("int_rate"), rate_fill),
            "annual_inc_joint": F.coalesce(F.col("annual_inc_joint"), joint_fill),
            "description": F.coalesce(fx.standardise_text("description"), F.col("purpose")),
            "income_category": cats,
            "emp_length_imputed": F.coalesce(F.col("emp_length"), F.lit(p["emp_length_mode"])),
        })
        df = df.withColumn("emp_title", F.coalesce(
            F.col("emp_title"), _map(p["emp_title_group_modes"])[F.col("income_category")],
            F.lit(p["emp_title_mode"])))
        # -- outliers (log scale unless configured raw)
        a_lo, a_hi = p["annual_inc_caps"]
        j_lo, j_hi = p["joint_caps"]
        v_lo, v_hi = p["avg_cur_bal_caps"]
        income_base = fx.safe_ln("annual_inc") if cfg.income_scale == "log" else F.col("annual_inc")
        df = df.withColumns({
            "annual_log": income_base,
            "annual_logj": F.coalesce(fx.safe_ln("annual_inc_joint"), F.lit(0.0)),
            "log_avg_cur_bal": fx.safe_ln1p("avg_cur_bal"),
            "log_tot_cur_bal": fx.safe_ln1p("tot_cur_bal"),
        })
        df = df.withColumns({
            "annual_log_capped": fx.cap("annual_log", a_lo, a_hi),
            "annualjoint_log_capped": fx.cap("annual_logj", j_lo, j_hi),
            "avg_cur_bal_capped": fx.cap("log_avg_cur_bal", v_lo, v_hi),
            "tot_cur_bal_capped": fx.cap("log_tot_cur_bal", lower=p["tot_cur_bal_lower"]),
        })
        return df.withColumns({"annual_inc_joint_handled": F.col("annualjoint_log_capped"),
                               "avg_cur_bal_handled": F.col("avg_cur_bal_capped")})

    def transform_features(self, df: DataFrame) -> DataFrame:
        """Stage 2: features, encodings, recompose, scaling, drop."""
        p, cfg = self.params, self.config
        # -- features (on raw income / amount: recompose and scaling come later)
        issue = F.col("issue_date")
        if isinstance(df.schema["issue_date"].dataType, T.StringType):
            issue = fx.parse_date("issue_date")
        df = df.withColumn("issue_date", issue.cast("date"))
        df = df.withColumns({
            "month": F.month("issue_date"),
            "salary_can_cover": fx.salary_can_cover("annual_inc", "loan_amount"),
            "grade_category": fx.grade_letter("grade"),
            "loan_term": fx.digits_to_int("term"),
        })
        df = df.withColumn("monthly_installment",
                           fx.monthly_installment("loan_amount", "rate_imputed", "loan_term"))
        # -- encodings
        home = F.lower("home_ownership")
        verif = fx.standardise_text("verification_status")
        typ = F.lower("type")
        df = df.withColumns({"home_ownership": home, "verification_status": verif, "type": typ})
        onehots = (enc.onehot_columns("home_ownership", p["home_ownership_categories"], "home_ownership")
                   + enc.onehot_columns("verification_status", p["verification_categories"], "verification")
                   + enc.onehot_columns("type", p["type_categories"], "type"))
        df = df.select("*", *onehots)
        df = df.withColumns({
            "emp_length": fx.emp_length_regex("emp_length_imputed"),
            "term": F.col("loan_term"),
            "pymnt_plan": fx.bool_to_int("pymnt_plan"),
            "grade_category_encoded": _map(p["grade_category_codes"])[F.col("grade_category")],
            "state_encoded": _map(p["state_codes"])[F.col("state")],
            "addr_state_encoded": _map(p["addr_state_codes"])[F.col("addr_state")],
        })
        # -- recompose, scale, drop
        df = df.withColumns({
            "annual_inc": F.col("annual_log_capped"),
            "annual_inc_joint": F.col("annual_inc_joint_handled"),
            "avg_cur_bal": F.col("avg_cur_bal_handled"),
            "int_rate": F.col("rate_imputed"),
            "tot_cur_bal": F.col("tot_cur_bal_capped"),
        })
        if cfg.scale:
            lo, hi = cfg.feature_range
            df = df.withColumns({c: fx.minmax_scale(c, mn, mx, lo, hi)
                                 for c, (mn, mx) in p["minmax"].items()})
        return df.drop(*DROPPED)

    # ----------------------------------------------------------------- lookup
    def lookup_rows(self) -> list[tuple]:
        p, cfg = self.params, self.config
        rows = [("annual_inc_joint", "missing", "annual_inc" if cfg.joint_fill == "income" else "0"),
                ("emp_length", "missing", f"{p['emp_length_mode']}(mode)")]
        rows += [("home_ownership", v, f"home_ownership_{v}") for v in p["home_ownership_categories"][1:]]
        rows += [("emp_length", "10+ years", "11.0"), ("emp_length", "< 1 year", "0.0")]
        rows += [("term", v, str(n)) for v, n in p["term_values"]]
        rows += [("pymnt_plan", "True", "1"), ("pymnt_plan", "False", "0")]
        rows += [("grade_category", k, str(v)) for k, v in sorted(p["grade_category_codes"].items())]
        rows += [("verification_status", v, f"verification_{v}") for v in p["verification_categories"][1:]]
        rows += [("state", k, str(v)) for k, v in sorted(p["state_codes"].items())]
        rows += [("addr_state", k, str(v)) for k, v in sorted(p["addr_state_codes"].items())]
        rows += [("type", v, f"type_{v}") for v in p["type_categories"][1:]]
        return rows

    def lookup(self, spark: SparkSession) -> DataFrame:
        return enc.lookup_rows(spark, self.lookup_rows())

    # ------------------------------------------------------------ persistence
    def save(self, store) -> str:
        """Store as rows of a ``ParamStore`` (one JSON value per parameter)."""
        flat = {k: json.dumps(v) for k, v in self.params.items()}
        flat["__config__"] = json.dumps(asdict(self.config))
        return store.save(flat)

    @classmethod
    def load(cls, store, fit_id: str | None = None) -> "LoanPrepModel":
        raw = store.load(fit_id)
        cfg = LoanPrepConfig(**json.loads(raw.pop("__config__")))
        cfg.feature_range = tuple(cfg.feature_range)
        return cls(cfg, {k: json.loads(v) for k, v in raw.items()})


def _map(d: dict) -> Column:
    if not d:
        return F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    return F.map_from_arrays(F.lit(list(d)), F.lit(list(d.values())))


def fit_columns(raw: DataFrame) -> DataFrame:
    """The columns that a fit reads, names and types of loan made canonical."""
    df = normalise_names(raw) if any(c != c.lower() or " " in c for c in raw.columns) else raw
    return df.replace(TYPE_CANON, subset=["type"]).select(*FIT_COLUMNS)


class LoanPrep:
    def __init__(self, config: LoanPrepConfig | None = None):
        self.config = config or LoanPrepConfig()

    def fit(self, raw: DataFrame, state: FitState | None = None, part: str | None = None) -> LoanPrepModel:
        """Fit on ``raw`` together with the parts that ``state`` already holds."""
        state = state or FitState(raw.sparkSession)
        return self.model(state.add(fit_columns(raw), part))

    def model(self, state: FitState) -> LoanPrepModel:
        return LoanPrepModel(self.config, state.params(self.config))


def clean(df: DataFrame, config: LoanPrepConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit + transform; returns (cleaned, lookup)."""
    model = LoanPrep(config).fit(df)
    return model.transform(df), model.lookup(df.sparkSession)


ETL_CONFIG = LoanPrepConfig(income_scale="raw", scale=False)
