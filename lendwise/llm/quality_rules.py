"""Quality rules (native): a short-circuit cascade ordered by rejection per cost.

Each rule is a condition under which a document is rejected. On a hashed sample of
the documents the cascade estimates what each rule costs (the
characters that its declared work reads in the sample) and
which documents it rejects. It then orders the rules greedily by
documents rejected (among those that no earlier rule rejected) per cost. The order
becomes one CASE expression, so a rule's work is done only on documents that
all earlier rules passed. The order never changes the verdict, only the work
and the name of the first failed rule.

Windows of words repeated within a text are found inside the row: 64-bit window
hashes are sorted, neighbours compared, covered words counted. Nothing is
exploded or shuffled, however long a text.

Defined results: null and empty texts have no words and fail the base; very long texts are measured whole; repeated
rows and ids are judged alike; an empty table gives an empty result; extra
columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import WHITE_SPACE, word_array

#: Fixed values of the base: symbols, fewest words, largest share of repeated words.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PCT = 50, 50
SAMPLE_ROWS, SAMPLE_GRAIN = 5_000, 1 << 20
#: Up to so many repeated windows their places are found by lookup, above by sorting (the result is the same).
FEW = 16


@dataclass(frozen=True)
class Rule:
    """``rejects``: condition over the columns of ``measured``; ``work``: what
    evaluating it touches (a Column per document, in characters)."""

    name: str
    rejects: Column
    work: Column


def default_rules() -> list[Rule]:
    """Rules in the manner of public web-corpus filters (word lengths, symbols,
    repeated lines, shouting, bullets, ellipses, letters)."""
    c = F.col
    chars, nothing = F.length("text"), F.lit(1)
    count = lambda pattern: F.regexp_count(c("text"), F.lit(pattern))
    return [
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words")), nothing),
        Rule("symbols", c("n_symbols") * 10 > c("n_words"), nothing),
        Rule("repeated_lines", c("n_dup_lines") * 10 > c("n_lines") * 6, nothing),
        Rule("repeated_windows", c("n_repeat_words") * 100 > c("n_words") * 45, nothing),
        Rule("shouting", count(r"\p{Lu}") * 2 > c("word_chars"), chars),
        Rule("digits", count(r"\p{N}") * 2 > c("word_chars"), chars),
        Rule("exclamations", count("[!?]{2,}") * 5 > c("n_words"), chars),
        Rule("ellipses", count(r"(\.\.\.|…)[ \t]*(\n|$)") * 10 > c("n_lines") * 3, chars),
        Rule("bullets", count(r"(^|\n)[ \t]*[-*•●]") * 10 > c("n_lines") * 9, chars),
    ]


def removed_length(text: Column, characters: str) -> Column:
    """Code points of ``text`` without the given characters."""
    for x in characters:
        text = F.replace(text, F.lit(x), F.lit(""))
    return F.length(text)


def covered_words(starts: Column) -> Column:
    """Words covered by 3-word windows at the given ascending positions."""
    step = lambda acc, at: F.struct(
        (acc["n"] + at + 3 - F.greatest(acc["end"], at)).alias("n"), (at + 3).alias("end"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(starts, zero, step, lambda acc: acc["n"]).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and the base measures of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    df = df.select("*", word_array(F.col("text")).alias("words"),
                   F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{WHITE_SPACE}]")).alias("lines"))
    window = F.when(F.size("words") >= 3, F.slice(F.transform(
        "words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))), F.lit(1), F.size("words") - 2)
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select("doc_id", "text", F.size("words").cast("long").alias("n_words"),
                   removed_length(F.col("text"), " \t\n\x0b\f\r").cast("long").alias("word_chars"),
                   (F.length("text") - removed_length(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
                   F.size("lines").cast("long").alias("n_lines"),
                   (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   window.alias("windows"))
    # Hashes of windows found twice or more (each later find once); most texts have none or a few.
    df = df.withColumn("sorted", F.sort_array("windows"))
    df = df.withColumn("again", F.filter("sorted", lambda h, k: F.get("sorted", k - 1) == h))
    few = F.filter(F.transform("windows", lambda h, i: F.when(F.array_contains("again", h), i)), lambda i: i.isNotNull())
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(F.size("again") > FEW, pairs))
    same = lambda x, k: F.coalesce(F.get("pairs", k)["h"] == x["h"], F.lit(False))
    many = F.transform(F.filter("pairs", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])
    df = df.withColumn("n_repeat_words", F.when(F.size("again") == 0, F.lit(0).cast("long"))
                       .when(F.size("again") <= FEW, covered_words(few)).otherwise(covered_words(F.sort_array(many))))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PCT)
    # The (always true) condition keeps the optimizer from pushing a caller's filter below the measures,
    # which would write their expressions into one another and evaluate them again for every window.
    return df.select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
                     F.when(F.spark_partition_id() >= 0, base).alias("base_failed"))


def sample(docs: DataFrame, id_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` documents, chosen by a hash of the id: a bounded sample,
    the same on every run."""
    n = docs.count()
    keep = SAMPLE_GRAIN if n <= rows else int(SAMPLE_GRAIN * rows / n) + 1
    return docs.filter(F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(SAMPLE_GRAIN)) < keep)


def ordered_rules(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text",
                  sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by documents rejected per cost, estimated on the sample. Collects
    one row per combination of failed rules, at most 2^rules."""
    fails = F.concat(*[F.coalesce(r.rejects, F.lit(False)).cast("int").cast("string") for r in rules])
    seen = measured(sample(docs, id_col, sample_rows), id_col, text_col).filter("not base_failed")
    rows = seen.groupBy(fails.alias("fails")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(r.work).alias(f"work_{k}") for k, r in enumerate(rules)]).collect()
    left, order = list(range(len(rules))), []
    while left:
        passed = [r for r in rows if not any(r["fails"][k] == "1" for k in order)]
        worth = {k: sum(r["n"] for r in passed if r["fails"][k] == "1") / max(1, sum(r[f"work_{k}"] for r in passed)) for k in left}
        best = max(left, key=lambda k: (worth[k], -k))
        order.append(best)
        left.remove(best)
    return [rules[k] for k in order]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document the base measures, base_failed, kept, and failed_rule (the
    first rule of the cascade that rejects it, ``base``, or null)."""
    order = ordered_rules(docs, rules or default_rules(), id_col, text_col, sample_rows)
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:
        first = first.when(rule.rejects, F.lit(rule.name))
    out = measured(docs, id_col, text_col).withColumn("failed_rule", first)
    return out.select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
