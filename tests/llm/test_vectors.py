"""Centroid clustering and the metric range join against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from lendwise.llm import centroids, range_join

SCHEMA = "vec_id long, embedding array<float>, label int, key string, n_links int, id string, cluster string, vector int"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, None, "key", 7, "id", "c", 1) for i, v in vectors], schema)


def hard(dim=64, n=300, seed=4):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dim))
    rows = [(i, [float(x) for x in np.float32(centre[i % 6] + r.normal(size=dim) * (0.05 if i % 3 else 0.6))]) for i in range(n)]
    same = rows[5][1]
    rows += [(1_000, same), (1_000, same), (1_001, same), (None, same), (None, rows[8][1]), (2, rows[2][1])]  # copies, repeated rows, null ids
    rows += [(1_010, None), (1_011, []), (1_012, [0.0] * dim), (1_013, [float("nan")] + [1.0] * (dim - 1)), (1_014, [float("inf")] + [1.0] * (dim - 1)),
             (1_015, [None] + [1.0] * (dim - 1)), (1_016, [1.0] * (dim - 1)), (1_017, [1.0] * (dim - 1)), (1_018, [1.0] * dim), (1_019, [3.0] * dim), (1_020, [-1.0] * dim)]
    return rows


def lloyd(vectors, k, rounds, dim):
    """Integer Lloyd rounds by Python numbers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda t: (hashlib.sha256(f"1:{'' if t[0] is None else t[0]}".encode()).hexdigest(), t[1]))
    cents = [v for _, v in order[:k]]
    for turn in range(rounds + 1):
        at = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents]
            at.append((d.index(min(d)), min(d)))
        if turn < rounds:
            for j in range(len(cents)):
                mine = [v for (_, v), (c, _) in zip(kept, at, strict=True) if c == j]
                if mine:
                    cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    total = sum(d for _, d in at)
    return sorted((str(i), c, d, sum(e for b, e in at if b == c), total, hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                  for (i, _), (c, d) in zip(kept, at, strict=True))


@pytest.mark.parametrize(("k", "rounds"), [(16, 3), (5, 7), (400, 1)])
def test_clusters(spark, k, rounds):
    rows = hard()
    got = centroids.report(centroids.fit(table(spark, rows).repartition(3), k=k, rounds=rounds)).collect()
    assert sorted((str(r.vec_id), *r[1:]) for r in got) == lloyd(rows, k, rounds, 64)


def test_clusters_of_none(spark):
    assert centroids.report(centroids.fit(table(spark, []))).count() == 0
    assert centroids.report(centroids.fit(table(spark, [(1, None), (2, [1.0])]))).count() == 0
    with pytest.raises(Exception, match="must stay below"):
        centroids.fit(table(spark, [(1, [1e30] * 64)]))


def test_bounds_skip_evaluations_and_never_an_answer():
    r = np.random.default_rng(0)
    centre = r.integers(-400, 400, (8, 16))
    v = centre[r.integers(0, 8, 2_000)] + r.integers(-9, 10, (2_000, 16))
    history, at = [v[:8]], np.full(2_000, -1)
    seen, dist, evaluated = np.zeros((2_000, 8), np.uint16), np.zeros((2_000, 8)), []
    for _ in range(8):
        at, squares, n = centroids.assign(v, at, seen, dist, np.stack(history))
        exact = ((v[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (at == exact.argmin(axis=1)).all() and (squares == exact.min(axis=1)).all()
        evaluated.append(n)
        history.append(np.array([v[at == j].sum(axis=0) // max(1, (at == j).sum()) if (at == j).any() else history[-1][j] for j in range(8)]))
    assert evaluated[0] == 16_000 and evaluated[-1] < 4_000


def test_displacement_is_not_the_sum_of_drifts():
    """A centroid that goes away and comes back loosens no bound: only the own distances are evaluated."""
    v = np.array([[0, 0], [100, 0], [104, 0]])
    home, away = np.array([[0, 0], [102, 0]]), np.array([[0, 0], [40_000, 0]])
    seen, dist = np.zeros((3, 2), np.uint16), np.zeros((3, 2))
    at, _, _ = centroids.assign(v, np.full(3, -1), seen, dist, np.stack([home]))
    _, _, n = centroids.assign(v, at, seen, dist, np.stack([home, away, home]))
    assert n == 3


def linked(vectors, threshold):
    good = [(k, np.float64(np.float32(v))) for k, (_, v) in enumerate(vectors)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(vectors))}
    for a, x in good:
        for b, y in good:
            if a < b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _) in enumerate(vectors):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [vectors[j][0] for j in seen if vectors[j][0] is not None]
        least = min(ids) if ids else None
        out.append((str(i), len(links[k]), str(least), i == least))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"cell_rows": 20}, {"cell_rows": 40, "max_pivots": 3, "split_rows": 30}, {"cell_rows": 10_000, "split_rows": 50}])
def test_links(spark, options):
    rows = hard()
    got = range_join.near_groups(table(spark, rows).repartition(3), **options).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == linked(rows, 0.95)


def test_links_in_few_dimensions_and_doubles(spark):
    """Chains around a circle, at the threshold itself, and numbers whose squares overflow."""
    r = random.Random(2)
    rows = [(i, [math.cos(a), math.sin(a)]) for i, a in enumerate(r.random() * 6.28 for _ in range(90))]
    longer = [(200, [1, 0, 0, 0, 0]), (201, [19, 5, 3, 2, 1]), (202, [1e200, 0, 0, 0, 0]), (203, [1e-200, 0, 0, 0, 0]), (204, [19, 5, 3, 2, 1.0001])]
    rows += [(i, [float(x) for x in v]) for i, v in longer]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {x.vec_id: x for x in range_join.near_groups(df, cell_rows=9).collect()}
    assert [got[k].n_links for k in range(200, 205)] == [3, 4, 3, 3, 1]
    want = linked([(i, [float(np.float32(x)) for x in v]) for i, v in rows[:90]], 0.95)
    single = spark.createDataFrame([(i, [float(np.float32(x)) for x in v]) for i, v in rows[:90]], "vec_id long, embedding array<double>")
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in range_join.near_groups(single, cell_rows=9).collect()) == want


def test_links_of_none_and_dedup(spark):
    assert range_join.near_groups(table(spark, [])).count() == 0
    df = table(spark, hard())
    out = range_join.near_dedup(df)
    assert out.columns == df.columns
    ids = [x[0] for x in linked(hard(), 0.95) if x[3]]
    assert sorted({str(x.vec_id) for x in out.collect()}) == sorted(set(ids))


def test_pivots_lie_apart_and_visits_cover_every_link():
    r = np.random.default_rng(3)
    x = range_join.units(np.repeat(r.normal(size=(40, 8)), 20, axis=0) + r.normal(size=(800, 8)) * 0.2)
    pivots = range_join.spread_pivots(x, 12)
    home, asked = range_join.visits(x, pivots, 0.95)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.95, 1))
    apart = home[a] != home[b]
    a, b = a[apart], b[apart]
    assert len(a) > 100 and (asked[a, home[b]] ^ asked[b, home[a]]).sum() == (asked[a, home[b]] | asked[b, home[a]]).sum() == len(a)
    assert asked.mean() < 0.3
