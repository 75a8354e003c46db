"""Mixing sources to target weights (native).

Words are aggregated per source, target words follow from weights and a total,
the repetition rate of a source is target / size, and each document is emitted
``floor(rate)`` times plus one Bernoulli copy whose probability is the rate's
fraction. The coin is a hash of (seed, id, text), so reruns agree and no
partitioning or order enters.

Defined results: null text has size 0; very long texts are counted whole; a null source is a source of its own,
ranked last; a source of size 0 has target and rate 0 (its documents carry no
words, none is emitted); repeated rows are tossed alike; an empty table gives
an empty result. Extra columns are carried along and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lendwise.llm.common import new_names, numbered, small_enough, word_count, written

#: Fixed values of the mixture: weights by rank of the source, repeated; the
#: mix's words as a multiple of all words; the most repetitions of a source.
WEIGHTS, SHARE, CAP, SEED = (3, 1, 2), 1.5, 2.0, 20_240_607


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Targets are ``min(cap * size, level * weight)`` with the one level at which
    they add up to ``share`` of all words: what resharing the excess of capped
    sources by weight converges to. Sources in order of (cap * size / weight):
    the level is found at the first source that it does not lift above its cap.
    The table of sources is ranked and summed in ranges of its order, a task per range; the driver
    holds the sums of each range.
    """
    sized = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = F.col("source").asc_nulls_last()
    per = numbered(sized, [by_source], "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("w"), (F.col("source_size") * float(cap)).alias("most"))
    per = per.withColumn("full_at", F.col("most") / F.col("w"))
    per = written(per.repartitionByRange("full_at", by_source).withColumn("part", F.spark_partition_id()), "levels")
    sums = per.groupBy("part").agg(F.sum("most").alias("most"), F.sum("w").alias("w"), F.sum("source_size").alias("n")).orderBy("part").collect()
    starts, most, left = [], 0.0, sum(r["w"] for r in sums)
    for r in sums:
        left -= r["w"]
        starts.append((r["part"], most, left))
        most += r["most"]
    offsets = F.broadcast(sized.sparkSession.createDataFrame(starts, "part int, most_before double, w_after double"))
    order = Window.partitionBy("part").orderBy("full_at", by_source)
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + F.col("most_before")
    left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)) + F.col("w_after")
    total = F.lit(float(sum(r["n"] for r in sums) * float(share)))
    levels = per.join(offsets, "part").select("full_at", ((total - before) / left).alias("level"))
    # Of sources that are full at one level the first has the greatest.
    first = F.min(F.struct("full_at", (-F.col("level")).alias("level")))["level"]
    at = levels.filter(F.col("level") <= F.col("full_at")).agg((-first).alias("at")).first()["at"]
    target = F.col("most") if at is None else F.least(F.col("most"), F.lit(at) * F.col("w"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, id_col: Column, text_hash: Column, seed: int = SEED) -> Column:
    """floor(rate) and one more with the probability of the fraction."""
    toss = F.pmod(F.xxhash64(F.lit(seed).cast("long"), id_col, text_hash), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (F.floor(rate) + (toss < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized, targets): one written row per document (id, source, size,
    text_hash, no text), and the per-source table."""
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_hash")), "sizes")
    targets = written(source_targets(sized, weights, share, cap), "targets")
    return sized, targets


def with_targets(rows: DataFrame, targets: DataFrame, source: Column) -> DataFrame:
    """Join the per-source table to rows. It is broadcast when its measured size
    allows; beyond that a shuffled join, whose hot sources Spark splits."""
    side = F.broadcast(targets) if small_enough(targets, targets.columns[0]) else targets
    return rows.join(side, source.eqNullSafe(side[targets.columns[0]]), "left")


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Per document: size, source_size, target of its source, and taken, the
    words that the mix takes from it (repeats counted)."""
    sized, targets = mixed(docs, id_col, text_col, source_col, **options)
    targets = targets.withColumnRenamed("source", "of_source")
    n = copies(F.col("rate"), F.col("id"), F.col("text_hash"), options.get("seed", SEED))
    return with_targets(sized, targets, F.col("source")).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it."""
    _, targets = mixed(docs, id_col, text_col, source_col, **options)
    s, size, target, rate, copy = new_names(docs.columns, "source", "size", "target", "rate", "copy")
    targets = targets.toDF(s, size, target, rate)
    n = copies(F.col(rate), docs[id_col], F.xxhash64(docs[text_col]), options.get("seed", SEED))
    out = with_targets(docs, targets, docs[source_col].cast("string"))
    out = out.withColumn(copy, n).filter(F.col(copy) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).drop(s, size, target, rate, copy)
