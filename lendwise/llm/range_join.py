"""Embedding near-dedup: an exact metric range join on pivots.

Vectors link when their cosine is at least ``threshold``, that is when the angle between
them is at most r = acos(threshold). Angles are a metric on directions.

1. Equal vectors (bytes) become one representative with a multiplicity, so a
   very common vector costs one row.
2. Pivots, chosen far from each other among a bounded sample, partition the representatives:
   each is at home in the cell of its nearest pivot.
3. Boundary replication: let x be at home with p and y with q, linked. With w the direction from
   p to q, y is within 90 degrees of w, so by the triangle inequality x is within 90 degrees + r of
   it: cos(x, w) >= -sin r. Only cells that pass this test can hold partners of x. For two
   cells one fixed side visits the other, so each pair of cells meets once.
4. Cells join independently. A cell's home rows are cut into blocks and its visitors into
   splits, by hash and by the counted sizes, so a task's share is bounded whatever the cell; blocks of
   one cell visit each other by the same one-sided rule. A task compares its visitors with its block by
   matrix products and emits per vector its number of partners and a spanning forest of the links, never the pairs.
5. Numbers of links add up; components of the forests are found by rounds of joins.

The result is exact whatever the pivots. They decide how many cells a vector
visits: few for vectors in clusters, but about half of all cells for directions without any structure in many
dimensions, where no metric partition prunes much. Cells hold about ``cell_rows`` representatives; the pivots
that every task gets are at most ``max_pivots``, beyond which cells grow and are cut into more blocks.

Defined results: a vector that is null, empty, zero, or has a null or non-finite component links
with nothing and is its own component; vectors of different lengths never link; repeated rows are
linked like others; null ids never name a component unless all its ids are null; the rows
whose id names the component are kept (with null ids: where all are); an empty table gives an empty result; extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import looked_up, new_names, released, small_enough, written
from lendwise.llm.components import component_roots

THRESHOLD = 0.95
CELL_ROWS, MAX_PIVOTS, CANDIDATES, SPLIT_ROWS = 4_096, 512, 4_096, 65_536
#: Cosines this close to the threshold are computed again from the unscaled vectors.
NEAR = 1e-9


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; powers of two first, so that squares neither overflow nor vanish."""
    x = rows.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``."""
    a, b = (np.ldexp(x.astype(np.float64), -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None]) for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def matrix(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary vectors of one length as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def keyed(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(rows written as id, key, vector; number format): the vector's bytes and their
    128-bit digest, both null where the vector links with nothing."""
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    x = F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | ~F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(F.size(x) > 0, F.when(~bad, x)).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [None if v is None else np.array(v, kind).tobytes() for v in b.column(1).to_pylist()]
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["id", "key", "vector"])

    return written(rows.mapInArrow(released(run), f"id {dict(rows.dtypes)['id']}, key binary, vector binary"), "vectors"), kind


def spread_pivots(candidates: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the unit vectors, each the one farthest from those chosen before."""
    chosen, nearest = [0], candidates @ candidates[0]
    while len(chosen) < min(n, len(candidates)):
        k = int(nearest.argmin())
        if nearest[k] >= 1 - NEAR:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, candidates @ candidates[k])
    return candidates[chosen]


def choose_pivots(reps: DataFrame, kind: str, total: int, cell_rows: int, max_pivots: int) -> dict[int, np.ndarray]:
    """Pivots by vector size in bytes, from at most CANDIDATES representatives."""
    sample = reps.select("vector").orderBy("key").limit(CANDIDATES).collect()
    by: dict[int, list[bytes]] = {}
    for r in sample:
        by.setdefault(len(r["vector"]), []).append(bytes(r["vector"]))
    share = min(max_pivots, -(-total // cell_rows)) / max(1, len(sample))
    return {size: spread_pivots(units(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)), max(1, round(share * len(raw))))
            for size, raw in by.items()}


def visits(unit: np.ndarray, pivots: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, matrix of the cells to visit) of unit vectors."""
    near = unit @ pivots.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        toward = (near - near[np.arange(len(unit)), home][:, None]) / apart[home]
    cell = np.arange(len(pivots))
    asked = visitor(home[:, None], cell[None, :]) & (cell[None, :] != home[:, None])
    reach = np.sqrt(1 - threshold * threshold) if threshold > 0 else np.inf
    return home, asked & ~(toward < -reach - NEAR)


def visitor(a, b):
    """Whether rows at home in ``a`` visit ``b`` (else the other way round): one of the two, in turns."""
    return (a < b) == ((a + b) % 2 == 1)


def placed(reps: DataFrame, kind: str, pivots: dict[int, np.ndarray], threshold: float) -> DataFrame:
    def run(batches):
        for b in batches:
            raw = b.column(2).to_pylist()
            size = np.array([len(r) for r in raw])
            home, cells = np.zeros(len(raw), np.int32), [[]] * len(raw)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                if s in pivots:
                    own, asked = visits(units(matrix(pa.array([raw[i] for i in at]), kind)), pivots[int(s)], threshold)
                    home[at] = own
                    for i, row in zip(at, asked, strict=True):
                        cells[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(size.astype(np.int32)), pa.array(home),
                                              pa.array(cells, pa.list_(pa.int32()))], ["rid", "n", "vector", "size", "home", "visits"])

    return written(reps.select("rid", "n", "vector").mapInArrow(released(run), "rid long, n long, vector binary, size int, home int, visits array<int>"), "placed")


def tiles(rows: DataFrame, cell_rows: int, split_rows: int) -> DataFrame:
    """Every representative in every (cell, block, split) where it is an owner (at home) or a visitor."""
    stays = rows.groupBy("size", F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("homes"))
    comes = rows.select("size", F.explode("visits").alias("cell")).groupBy("size", "cell").agg(F.count(F.lit(1)).alias("guests"))
    blocks = F.ceil(F.col("homes") / cell_rows)
    guests = F.coalesce("guests", F.lit(0)) + F.when(blocks > 1, F.col("homes")).otherwise(0)
    cells = written(stays.join(comes, ["size", "cell"], "left").select(
        "size", "cell", blocks.cast("int").alias("blocks"), F.greatest(F.ceil(guests / split_rows), F.lit(1)).cast("int").alias("splits")), "cells")
    cells = F.broadcast(cells) if small_enough(cells) else cells
    block, split = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64(F.lit(7), "rid"), F.col("splits")).cast("int")
    home = rows.withColumn("cell", F.col("home")).join(cells, ["size", "cell"]).withColumn("own", block)
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    slim = ["size", "cell", "block", "split", "guest", "rid", "n", "vector"]
    owners = home.withColumn("block", F.col("own")).withColumn("split", F.explode(every("splits"))).withColumn("guest", F.lit(False))
    beside = F.filter(every("blocks"), lambda b: (b != F.col("own")) & ((F.col("own") < b) == ((F.col("own") + b) % 2 == 1)))
    inner = home.withColumn("split", split).withColumn("block", F.explode(beside)).withColumn("guest", F.lit(True))
    outer = rows.withColumn("cell", F.explode("visits")).join(cells, ["size", "cell"])  # a cell where nobody is at home has no visitors to meet
    outer = outer.withColumn("split", split).withColumn("block", F.explode(every("blocks"))).withColumn("guest", F.lit(True))
    return owners.select(slim).unionByName(inner.select(slim)).unionByName(outer.select(slim))


def hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the components of ``a`` and ``b``, elementwise: roots hook onto lesser roots."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(label, nxt := label[label]):
            label = nxt


def compare(kind: str, threshold: float, chunk: int = 512):
    """One (cell, block, split): partners of its rows and a spanning forest of its links."""
    def run(table: pa.Table) -> pa.Table:
        guest = table["guest"].to_numpy()
        order = np.argsort(guest, kind="stable")
        m = int((~guest).sum())
        rid, n, raw = table["rid"].to_numpy()[order], table["n"].to_numpy()[order], matrix(table["vector"], kind)[order]
        unit, label = units(raw), np.arange(len(raw))
        partners = np.zeros(len(raw), np.int64)
        first = table["split"][0].as_py() == 0  # owners meet each other in the first split only
        for a in [*range(0, m if first else 0, chunk), *range(m, len(raw), chunk)]:
            b = min(a + chunk, m if a < m else len(raw))
            near = unit[a:b] @ unit[:m].T
            hit = near >= threshold
            i, j = np.nonzero(np.abs(near - threshold) < NEAR)
            for k in range(0, len(i), 1 << 14):
                s, t = i[k:k + (1 << 14)], j[k:k + (1 << 14)]
                hit[s, t] = cosines(raw[a + s], raw[t]) >= threshold
            if a < m:  # each pair of owners once
                hit &= np.arange(a, b)[:, None] > np.arange(m)[None, :]
            i, j = np.nonzero(hit)
            np.add.at(partners, a + i, n[j])
            np.add.at(partners, j, n[a + i])
            label = hook(label, a + i, j)
        at, inner = np.flatnonzero(partners), np.flatnonzero(label != np.arange(len(raw)))
        empty = pa.nulls(len(at), pa.int64())
        return pa.table({"a": np.concatenate([rid[at], rid[inner]]), "partners": pa.concat_arrays([pa.array(partners[at]), pa.nulls(len(inner), pa.int64())]),
                         "b": pa.concat_arrays([empty, pa.array(rid[label[inner]])])})

    return run


def near_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS,
                max_pivots: int = MAX_PIVOTS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per vector: id, n_links (other rows linked to it), component_id (the least id reachable), kept."""
    rows, kind = keyed(vectors, id_col, vector_col)
    same = rows.filter("key is not null").groupBy("key").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    reps = written(same.withColumn("rid", F.monotonically_increasing_id()), "representatives")
    pivots = choose_pivots(reps, kind, reps.count(), cell_rows, max_pivots)
    met = tiles(placed(reps, kind, pivots, threshold), cell_rows, split_rows)
    found = written(met.groupBy("size", "cell", "block", "split").applyInArrow(compare(kind, threshold), "a long, partners long, b long"), "found")
    partners = found.filter("partners is not null").groupBy(F.col("a").alias("rid")).agg(F.sum("partners").alias("partners"))
    roots = component_roots(found.filter("b is not null").select("a", "b")).select(F.col("a").alias("rid"), F.col("b").alias("root"))
    labelled = written(reps.select("rid", "key", "n", "least").join(partners, "rid", "left").join(roots, "rid", "left").select(
        "key", "n", "least", F.coalesce("root", "rid").alias("root"), (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("n_links")), "labelled")
    heads = written(labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "heads")
    entries = written(looked_up(labelled.drop("least"), heads, ["root"], "members").select("key", "n", "n_links", "component_id"), "entries")
    linked = looked_up(rows.filter("key is not null").select("id", "key"), entries, ["key"], "n").select("id", "n_links", "component_id")
    alone = rows.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """The rows of ``vectors`` whose id names their component."""
    (key,) = new_names(vectors.columns, "kept_id")
    kept = near_groups(vectors, id_col, vector_col, **options).filter("kept").select(F.col(id_col).alias(key)).distinct()
    return vectors.join(kept, vectors[id_col].eqNullSafe(kept[key]), "left_semi")
