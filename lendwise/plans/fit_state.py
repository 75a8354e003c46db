"""The state of a fit as rows that merge.

A fit is made of parts, one per batch of input (``add``). A part holds

* ``statistics``: per (feature, value) the number of rows and, for the loan status, count and exact
  decimal sum of the rate and extremes of the amounts. Parts merge by sums, minima and maxima;
* ``numbers``: the few columns whose exact quantiles and group modes depend on all rows
  together, projected. Parts merge by union, and the selection passes read only them.

Both are tables in the shared folder: nothing is kept on executors, a lost one costs a task, and new files
are read once and added to what is there. A part counts when its mark is
written, last; adding a part of the same name replaces it. The fit of parts A and
B equals the fit of their rows together.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.functions import features as fx
from lendwise.operators import ordered
from lendwise.operators.outliers import iqr_fences
from lendwise.sources.files import listed, publish, scratch_path

NUMBERS = ["annual_inc", "annual_inc_joint", "avg_cur_bal", "tot_cur_bal", "emp_title"]
STATUS = "loan_status"
CATEGORIES = ["home_ownership", "verification_status", "type", "state", "addr_state", "term", "grade_category"]
#: Parameters that the model keeps under another name than the column.
CODES = ["state", "addr_state", "grade_category"]
PROBS = [1 / 3, 2 / 3, 0.25, 0.75, 0.05, 0.95]


def category_columns() -> dict:
    return {"home_ownership": F.lower("home_ownership"), "verification_status": fx.standardise_text("verification_status"), "type": F.lower("type"),
            "state": F.col("state"), "addr_state": F.col("addr_state"), "term": F.col("term"), "grade_category": fx.grade_letter("grade")}


def statistics(df: DataFrame) -> DataFrame:
    """One pass: (feature, value) with n; rate_n, rate_sum and la0, la1, fa0, fa1 of the loan status."""
    named = {**category_columns(), "emp_length": F.col("emp_length"), "emp_title": F.col("emp_title"), STATUS: F.col(STATUS)}
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), c.cast("string").alias("value")) for k, c in named.items()])).alias("f"),
                     "int_rate", "loan_amount", "funded_amount").select("f.*", "int_rate", "loan_amount", "funded_amount")
    rows = rows.where(F.col("value").isNotNull() | (F.col("feature") == STATUS))
    own = lambda c: f"CASE WHEN feature = '{STATUS}' THEN {c} END"
    return rows.groupBy("feature", "value").agg(
        F.expr("count(1)").alias("n"), F.expr(f"count({own('int_rate')})").alias("rate_n"),
        F.expr(f"CAST(sum({own('CAST(int_rate AS DECIMAL(26,15))')}) AS DECIMAL(38,15))").alias("rate_sum"),
        F.expr(f"min({own('loan_amount')})").alias("la0"), F.expr(f"max({own('loan_amount')})").alias("la1"),
        F.expr(f"min({own('funded_amount')})").alias("fa0"), F.expr(f"max({own('funded_amount')})").alias("fa1"))


def merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("feature", "value").agg(
        F.sum("n").alias("n"), F.sum("rate_n").alias("rate_n"), F.expr("CAST(sum(rate_sum) AS DECIMAL(38,15))").alias("rate_sum"),
        F.min("la0").alias("la0"), F.max("la1").alias("la1"), F.min("fa0").alias("fa0"), F.max("fa1").alias("fa1"))


class FitState:
    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark, self.base = spark, (base or scratch_path(spark, "fit")).rstrip("/")

    def add(self, df: DataFrame, part: str | None = None) -> "FitState":
        """Add a batch of prepared rows (``pipeline.fit_columns``) as a part."""
        name = part or uuid.uuid4().hex
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
            raise ValueError(f"a part's name is made of letters, digits, _ . and -, a letter or digit first: {name!r}")
        df.select(*NUMBERS).write.mode("overwrite").parquet(f"{self.base}/numbers/{name}")
        statistics(df).write.mode("overwrite").parquet(f"{self.base}/statistics/{name}")
        publish(self.spark, f"{self.base}/parts/{name}")
        return self

    def parts(self) -> list[str]:
        """Names of the complete parts."""
        return listed(self.spark, f"{self.base}/parts")

    def tables(self) -> tuple[DataFrame, DataFrame]:
        """(statistics, numbers) of all complete parts."""
        parts = self.parts()
        if not parts:
            raise ValueError(f"nothing was added to the fit at {self.base}")
        stats, numbers = (self.spark.read.parquet(*[f"{self.base}/{t}/{p}" for p in parts]) for t in ("statistics", "numbers"))
        return (stats if len(parts) == 1 else merged(stats)), numbers

    def params(self, config) -> dict:
        """The fitted parameters. Every collected list is bounded by ``config.max_categories`` and checked first."""
        stats, numbers = self.tables()
        most = config.max_categories
        sizes = {r["feature"]: r for r in stats.where(F.col("value").isNotNull() | (F.col("feature") == STATUS)).groupBy("feature").agg(
            F.expr("min_by(named_struct('value', value, 'n', n), named_struct('n', -n, 'v', value))").alias("mode"), F.expr("count(1)").alias("n_values")).collect()}
        bounded = [*CATEGORIES, STATUS]
        for k in bounded:
            if k in sizes and sizes[k]["n_values"] > most:
                raise ValueError(f"{k}: more than {most} distinct values; raise max_categories or encode it with the distributed encoders in operators.encode")
        rows = stats.where(F.col("feature").isin(bounded)).collect()
        values = {k: sorted(r["value"] for r in rows if r["feature"] == k and r["value"] is not None) for k in CATEGORIES}
        p = self._rates([r for r in rows if r["feature"] == STATUS])
        p["home_ownership_categories"], p["verification_categories"], p["type_categories"] = (values[k] for k in CATEGORIES[:3])
        for k in CODES:
            p[f"{k}_codes"] = {v: i for i, v in enumerate(values[k])}
        digits = [(v, re.search(r"[0-9]+", v)) for v in values["term"]]
        p["term_values"] = [[v, int(d.group())] for v, d in digits if d]
        p["emp_length_mode"] = sizes["emp_length"]["mode"]["value"] if "emp_length" in sizes else None
        p |= self._quantiles(numbers, config)
        p |= self._titles(stats, numbers, p["income_terciles"], sizes.get("emp_title"))
        return p

    @staticmethod
    def _rates(rows: list) -> dict:
        means = {r["value"]: float(r["rate_sum"]) / r["rate_n"] for r in rows if r["value"] is not None and r["rate_n"]}
        total = float(sum(r["rate_sum"] or 0 for r in rows))
        count = sum(r["rate_n"] for r in rows)
        for r in sorted((r for r in rows if r["value"] in means), key=lambda r: r["value"]):  # mean of the group-filled rate
            total += (r["n"] - r["rate_n"]) * means[r["value"]]
            count += r["n"] - r["rate_n"]
        extreme = lambda k, of: of((r[k] for r in rows if r[k] is not None), default=None)
        return {"rate_group_means": dict(sorted(means.items())), "mean_int_rate": total / count if count else None,
                "minmax": {"loan_amount": [extreme("la0", min), extreme("la1", max)], "funded_amount": [extreme("fa0", min), extreme("fa1", max)]}}

    @staticmethod
    def _quantiles(numbers: DataFrame, config) -> dict:
        joint = F.coalesce("annual_inc_joint", F.col("annual_inc") if config.joint_fill == "income" else F.lit(0.0))
        base = fx.safe_ln("annual_inc") if config.income_scale == "log" else F.col("annual_inc")
        feats = numbers.select("annual_inc", base.alias("annual_log"), fx.safe_ln(joint).alias("annual_logj"),
                               fx.safe_ln1p("avg_cur_bal").alias("log_avg_cur_bal"), fx.safe_ln1p("tot_cur_bal").alias("log_tot_cur_bal"))
        found = ordered.quantiles(ordered.long_form(feats, feats.columns), "value", PROBS, group=["feature"], approx=config.approx).collect()
        by = {(r["feature"], round(r["prob"], 12)): r["value"] for r in found}
        q = lambda feature, *at: [by.get((feature, round(x, 12))) for x in at]
        edges = q("annual_inc", 1 / 3, 2 / 3)
        if None in edges or not edges[0] < edges[1]:
            raise ValueError(f"income tercile edges must be unique: {edges}")
        return {"income_terciles": edges, "annual_inc_caps": list(iqr_fences(*q("annual_log", 0.25, 0.75))),
                "joint_caps": list(iqr_fences(*q("annual_logj", 0.25, 0.75))), "avg_cur_bal_caps": q("log_avg_cur_bal", 0.05, 0.95),
                "tot_cur_bal_lower": iqr_fences(*q("log_tot_cur_bal", 0.25, 0.75))[0]}

    @staticmethod
    def _titles(stats: DataFrame, numbers: DataFrame, edges: list[float], whole) -> dict:
        """Mode of the title per income tercile, and after that fill. The latter is a group mode
        (with the rows that it fills) or the mode before the fill: no other title gains rows."""
        tercile = F.expr(f"CASE WHEN annual_inc <= {edges[0]!r}D THEN 'q1' WHEN annual_inc <= {edges[1]!r}D THEN 'q2' WHEN annual_inc IS NOT NULL THEN 'q3' END")
        counted = numbers.groupBy(tercile.alias("tercile"), "emp_title").agg(F.expr("count(1)").alias("n")).where("tercile IS NOT NULL")
        per = counted.groupBy("tercile").agg(
            F.expr("min_by(emp_title, named_struct('n', -n, 'v', emp_title)) FILTER (WHERE emp_title IS NOT NULL)").alias("mode"),
            F.expr("coalesce(sum(n) FILTER (WHERE emp_title IS NULL), 0L)").alias("filled")).collect()
        modes = {r["tercile"]: r["mode"] for r in sorted(per, key=lambda r: r["tercile"]) if r["mode"] is not None}
        if whole is None:
            return {"emp_title_group_modes": modes, "emp_title_mode": None}
        totals = {r["value"]: r["n"] for r in stats.where((F.col("feature") == "emp_title") & F.col("value").isin(sorted(set(modes.values())))).collect()}
        totals[whole["mode"]["value"]] = whole["mode"]["n"]
        for r in per:
            if r["mode"] is not None:
                totals[r["mode"]] += r["filled"]
        return {"emp_title_group_modes": modes, "emp_title_mode": min(totals, key=lambda t: (-totals[t], t.encode()))}
