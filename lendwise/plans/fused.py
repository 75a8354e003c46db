"""Many reports from few reads.

A report is a keyed aggregate over the same rows. ``keyed_pass`` computes any
number of them in one grouped aggregate over (report, key): each row yields one small entry per
report that it counts for, combined map-side. ``column_facts`` computes all that needs no
key in one row, ``quantile_facts`` the quantiles of all numeric columns by one selection. What the second
round of reports needs (fences, bins, terciles) comes as literals from those.

Results of a keyed pass are written to the shared folder and each report is
read from there, so the input is read once per pass, whatever the number of reports.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.functions.agg import MONEY_TYPE
from lendwise.operators import ordered
from lendwise.sources.files import scratch_path


@dataclass(frozen=True)
class Keyed:
    """One report: SQL text of its key columns (up to KEYS), up to two measures, the rows that count, and the measures ("x",
    "y" or "xy") whose exact sums it needs."""

    name: str
    key: tuple[str, ...] = ()
    x: str = "NULL"
    y: str = "NULL"
    where: str = "TRUE"
    sums: str = ""


#: Key columns of a keyed pass.
KEYS = 3
#: Aggregates of a keyed pass; sums are exact (money), averages plain.
MEASURES = {"n": "count(1)", "x_n": "count(x)", "x_sum": "CAST(sum(x_money) AS DOUBLE)", "x_avg": "avg(x)", "x_min": "min(x)",
            "x_max": "max(x)", "y_n": "count(y)", "y_sum": "CAST(sum(y_money) AS DOUBLE)"}


def keyed_pass(df: DataFrame, reports: Sequence[Keyed]) -> "KeyedTable":
    """Money values, dear to convert, are made once per row and measure, whatever the number of reports that sum it, and only for those."""
    needed: dict[str, list[str]] = {}  # measure -> rows that some report sums
    for r in reports:
        for m in r.sums:
            needed.setdefault(getattr(r, m), []).append(f"({r.where})")
    money = {m: f"_lw_money{i}" for i, m in enumerate(needed)}

    def entry(r: Keyed) -> str:
        keys = [f"CAST({k} AS STRING)" for k in r.key] + ["CAST(NULL AS STRING)"] * (KEYS - len(r.key))
        sums = [money[getattr(r, m)] if m in r.sums else f"CAST(NULL AS {MONEY_TYPE})" for m in "xy"]
        fields = ", ".join(f"'k{i}', {k}" for i, k in enumerate(keys))
        return (f"CASE WHEN {r.where} THEN named_struct('report', '{r.name}', {fields}, 'x', CAST({r.x} AS DOUBLE), 'y', CAST({r.y} AS DOUBLE), "
                f"'x_money', {sums[0]}, 'y_money', {sums[1]}) END")

    rows = df.withColumns({name: F.expr(f"CASE WHEN {' OR '.join(dict.fromkeys(needed[m]))} THEN CAST(CAST({m} AS DOUBLE) AS {MONEY_TYPE}) END")
                           for m, name in money.items()})
    entries = F.expr(f"explode(array({', '.join(map(entry, reports))}))").alias("e")
    table = rows.select(entries).where("e IS NOT NULL").select("e.*")
    table = table.groupBy("report", *[f"k{i}" for i in range(KEYS)]).agg(*[F.expr(sql).alias(name) for name, sql in MEASURES.items()])
    path = scratch_path(df.sparkSession, "reports")
    table.write.parquet(path)
    return KeyedTable(df.sparkSession.read.schema(table.schema).parquet(path), {r.name: r.sums for r in reports})


@dataclass
class KeyedTable:
    rows: DataFrame
    sums: dict[str, str]

    def of(self, name: str, key: dict[str, str] | None = None, **columns: str) -> DataFrame:
        """A report's rows: key columns (name -> type) and columns (name -> SQL text over the measures)."""
        missing = [m for m in "xy" if m not in self.sums[name] and any(f"{m}_sum" in sql for sql in columns.values())]
        if missing:
            raise ValueError(f"report {name!r} was not asked for sums of {missing}")
        keys = [F.expr(f"CAST(k{i} AS {kind})").alias(k) for i, (k, kind) in enumerate((key or {}).items())]
        return self.rows.where(F.col("report") == name).select(*keys, *[F.expr(sql).alias(k) for k, sql in columns.items()])


MONEY_AVG = "try_divide({0}_sum, CAST({0}_n AS DOUBLE))"


def numeric_columns(df: DataFrame, leave: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in leave]


def column_facts(df: DataFrame) -> dict[str, dict]:
    """One read: per column its rows and non-null values, of numeric ones also min, max, mean and sample deviation."""
    numeric = numeric_columns(df)
    aggs = [F.expr("count(1)").alias("rows")] + [F.expr(f"count(`{c}`)").alias(f"{c}__values") for c in df.columns]
    for c in numeric:
        aggs += [F.expr(f"CAST({f}(`{c}`) AS DOUBLE)").alias(f"{c}__{name}") for name, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))]
    row = df.agg(*aggs).first()
    return {c: {"rows": row["rows"], "values": row[f"{c}__values"]} | ({k: row[f"{c}__{k}"] for k in ("min", "max", "mean", "std")} if c in numeric else {})
            for c in df.columns}


def quantile_facts(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Exact quantiles of all columns by one selection (two reads); None for a column without values."""
    found = ordered.exact_quantiles(ordered.long_form(df, columns), "value", probs, group=["feature"]).collect()
    by = {(r["feature"], round(r["prob"], 12)): r["value"] for r in found}
    return {c: [by.get((c, round(p, 12))) for p in probs] for c in columns}


def long_table(frames, keys: dict[str, list[str]]) -> DataFrame:
    """(report, key, measure, value): every report's remaining columns as rows, keys joined by '|', null as '~'."""
    parts = []
    for name, key in keys.items():
        df = frames[name]
        joined = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("~")) for k in key]) if key else F.lit("")
        measures = [c for c in df.columns if c not in key]
        value = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("value")) for m in measures])).alias("m")
        parts.append(df.select(F.lit(name).alias("report"), joined.alias("key"), value).select("report", "key", "m.measure", "m.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
