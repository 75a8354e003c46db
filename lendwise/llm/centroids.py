"""Centroid clustering of integer vectors with Ns-bounds.

Lloyd's rounds whose result is exact, with distance tests that are skipped
where bounds prove them needless. Every vector carries, per centroid, its
distance when that centroid was last evaluated and the round of that evaluation. The
driver keeps the history of the centroids, so that a bound is loosened by the norm
of the centroid's *total* displacement since that round, |c(now) - c(then)|, which is never
more than the sum of the drifts round by round. A centroid whose loosened lower
bound exceeds the loosened upper bound of the vector's own centroid is skipped; the own distance is
then made exact, and every centroid that still fails is evaluated exactly.

All arithmetic that decides is on integers: components are ``floor(scale * x)``, squared distances and
sums are exact, ties go to the smaller centroid number. Bounds are doubles and get a slack, so
rounding can only cause a needless evaluation.

Each round is one map over the state table of the shared folder: a task writes
its vectors' new state together with its sums of the vectors that changed
cluster; the driver adds those up (k x dimension numbers, whatever the input)
and deletes the table before. Vectors are never shuffled.

Defined results: vectors that are null, of another length, or have a null or
non-finite component are left out; fewer vectors than ``k`` give as many
centroids; null ids are hashed as the empty text and stay null; repeated rows are vectors of their own, ties
among the starting vectors' hashes go to the smaller vector; an empty table gives an
empty result; extra columns may have any name. A component of 2^27 or more after scaling
is an error, since squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import discard, fresh_path, released

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, "1"
LIMIT = 1 << 27
STATE = "id {id}, vector binary, cluster int, seen binary, dist binary, distance long, sums array<long>"


@dataclass
class Clustering:
    """``assigned``: id, cluster, distance (squared) of every vector; ``centroids``: exact integer components."""

    assigned: DataFrame
    centroids: list[list[int]]


def usable(column, dim: int):
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.size(x) == dim, ~bad).otherwise(False)


def integers(vectors: pa.Array, scale: float, dim: int) -> np.ndarray:
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) * scale)
    if x.size and np.abs(x).max() >= LIMIT:
        raise ArithmeticError(f"scaled components must stay below {LIMIT}")
    return x.astype(np.int64)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def assign(v: np.ndarray, cluster: np.ndarray, seen: np.ndarray, dist: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """One exact assignment of vectors ``v`` to the last centroids of ``history`` (round, centroid,
    component). ``seen`` and ``dist`` are brought up to date in place. Returns
    (cluster, squared distance, evaluations)."""
    now, k = len(history) - 1, history.shape[1]
    rows, evaluated = np.arange(len(v)), 0
    centroids = history[now]
    if now == 0:
        exact = np.stack([squared(v, c) for c in centroids], axis=1)
        dist[:], seen[:] = np.sqrt(exact.astype(np.float64)), 0
        own = exact.argmin(axis=1)  # the first of equals
        return own, exact[rows, own], exact.size
    moved = np.sqrt(((history - centroids) ** 2).sum(axis=2).astype(np.float64))  # (round, centroid): total displacement since
    loose = np.take_along_axis(moved, seen.astype(np.int64), axis=0)
    slack = 1e-9 * (1.0 + dist + loose)
    lower, upper = dist - loose - slack, (dist + loose + slack)[rows, cluster]
    lower[rows, cluster] = np.inf
    open_ = (lower <= upper[:, None]).any(axis=1)
    best, squares = cluster.copy(), np.empty(len(v), np.int64)
    for j in range(k):  # the own distance is exact from here on
        at = np.flatnonzero(cluster == j)
        squares[at] = squared(v[at], centroids[j])
    evaluated += len(v)
    dist[rows, cluster], seen[rows, cluster] = np.sqrt(squares.astype(np.float64)), now
    upper = dist[rows, cluster] * (1 + 1e-12) + 1e-9
    failed = open_[:, None] & (lower <= upper[:, None])
    for j in range(k):
        at = np.flatnonzero(failed[:, j])
        if len(at):
            d = squared(v[at], centroids[j])
            dist[at, j], seen[at, j] = np.sqrt(d.astype(np.float64)), now
            better = (d < squares[at]) | ((d == squares[at]) & (j < best[at]))
            squares[at[better]], best[at[better]] = d[better], j
            evaluated += len(at)
    return best, squares, evaluated


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = K, rounds: int = ROUNDS,
        dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> Clustering:
    """Cluster ``floor(scale * vector)`` around ``k`` centroids, starting from the
    vectors with the least sha256 of ``<seed>:<id>``; ``rounds`` times assign and update, then assign."""
    spark = vectors.sparkSession
    rows = vectors.filter(usable(vector_col, dim)).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = [r["vector"] for r in rows.orderBy(hashed, "vector").limit(k).collect()]
    first = integers(pa.array(start, pa.list_(pa.float64())), scale, dim)
    id_type = dict(rows.dtypes)["id"]
    schema, k = STATE.format(id=id_type), len(first)
    if not k:
        return Clustering(spark.createDataFrame([], f"id {id_type}, cluster int, distance long"), [])
    history, sums, counts, path = [first], [[0] * dim for _ in range(k)], [0] * k, None
    for turn in range(rounds + 1):
        source = spark.read.schema(schema).parquet(path).filter("sums is null").drop("sums") if path else rows
        done = fresh_path(spark, f"round{turn}")
        source.mapInArrow(released(step(np.stack(history), scale, dim, path is None)), schema).write.parquet(done)
        if path:
            discard(spark, path)
        path = done
        if turn < rounds:
            for r in changes(spark.read.schema(schema).parquet(path)):
                if r["at"] == dim:
                    counts[r["cluster"]] += int(r["total"])
                else:
                    sums[r["cluster"]][r["at"]] += int(r["total"])
            history.append(np.array([[s // n for s in c] if n else list(old) for c, n, old in zip(sums, counts, history[-1].tolist(), strict=True)], np.int64))
    assigned = spark.read.schema(schema).parquet(path).filter("sums is null").select("id", "cluster", "distance")
    return Clustering(assigned, history[-1].tolist())


def changes(state: DataFrame) -> list:
    """(cluster, at, total): what tasks added to each cluster's component sums and, last, its count."""
    parts = state.filter("sums is not null").select("cluster", F.posexplode("sums").alias("at", "part"))
    return parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()


def step(history: np.ndarray, scale: int, dim: int, fresh: bool):
    """The map of one round: state rows, then one row of sums per cluster that the task's vectors left or joined."""
    k = history.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, id_type = np.zeros((k, dim + 1), np.int64), None
        for b in batches:
            n, id_type = b.num_rows, b.column(0).type
            if fresh:
                v, before = integers(b.column(1), scale, dim), np.full(n, -1)
                seen, dist = np.zeros((n, k), np.uint16), np.zeros((n, k))
            else:
                v = unpacked(b.column(1), "<i4", dim).astype(np.int64)
                before = b.column(2).to_numpy().astype(np.int64)
                seen, dist = unpacked(b.column(3), "<u2", k).copy(), unpacked(b.column(4), "<f8", k).copy()
            after, squares, _ = assign(v, before, seen, dist, history)
            for j in np.unique(np.concatenate([before, after])[np.tile(before != after, 2)]):
                for at, sign in ((after, 1), (before, -1)):
                    moved = v[(at == j) & (before != after)]
                    if j >= 0 and len(moved):
                        total[j, :dim] += sign * moved.sum(axis=0)
                        total[j, dim] += sign * len(moved)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), packed(v.astype("<i4")), pa.array(after.astype(np.int32)), packed(seen.astype("<u2")), packed(dist.astype("<f8")),
                 pa.array(squares), pa.nulls(n, pa.list_(pa.int64()))], NAMES)
        at = np.flatnonzero(total.any(axis=1))
        if not len(at):
            return
        none = [pa.nulls(len(at), t) for t in (id_type, pa.binary(), pa.binary(), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([none[0], none[1], pa.array(at.astype(np.int32)), none[2], none[3], none[4],
                                          pa.array(total[at].tolist(), pa.list_(pa.int64()))], NAMES)

    return run


NAMES = ["id", "vector", "cluster", "seen", "dist", "distance", "sums"]


def packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of the matrix."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def unpacked(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def report(found: Clustering, id_col: str = "vec_id") -> DataFrame:
    """Per vector its cluster and squared distance, the summed distances of the cluster and of all, and the
    sha256 of the final centroid's components as decimal integers joined by commas."""
    spark, rows = found.assigned.sparkSession, found.assigned
    inertia = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    per = [(j, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, found.centroids[j])).encode()).hexdigest()) for j, s in sorted(inertia.items())]
    digest = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(digest), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
