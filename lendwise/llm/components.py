"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import looked_up, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: large links each node's greater neighbours to its least
    neighbour or itself, small does so with its lesser neighbours and itself.
    A hub of very many edges finds its least neighbour without a shuffle."""
    both = edges.union(edges.select("b", "a")) if large else edges
    least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    found = looked_up(both, least, ["a"], "n")
    if large:
        out = found.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = found.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(a, b): every node with an edge, except the least of its component, and that
    least node. ``edges``: (a, b) of one orderable type. Alternates large-star and
    small-star steps until nothing changes; each round is written to the
    shared folder, and only a count and a checksum reach the driver."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seal = lambda e: e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    before = seal(edges)
    while before["n"]:
        edges = written(_stars(_stars(edges, True), False), "edges")
        now = seal(edges)
        if now == before:
            break
        before = now
    return edges
