"""Line dedup and SimHash near-dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import edge
from lendwise.llm import components, line_dedup, simhash


def line_sets(rows):
    """(place, number, words) of lines with a word, in order; rows repeated with id and text once."""
    last = (1 << 63) - 1
    seen = sorted({(last if r.doc_id is None else r.doc_id, r.text or "") for r in rows})
    return [((i, t), k, edge.words(edge.lowered(x))) for i, t in seen for k, x in enumerate(t.split("\n")) if edge.words(x)]


def removed(rows, num=4, den=5, k=5):
    lines, by, out = line_sets(rows), {}, {}
    sets = [frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) for _, _, w in lines]
    for n, ((place, number, _), s) in enumerate(zip(lines, sets, strict=True)):
        near = set().union(*(by.get(t, ()) for t in s))
        if any(den * len(s & sets[m]) >= num * len(s | sets[m]) for m in near):
            out.setdefault(place, []).append(number)
        for t in s:
            by.setdefault(t, set()).add(n)
    return out


def check_lines(df):
    rows = df.collect()
    want, last = removed(rows), (1 << 63) - 1
    expected = sorted((str(r.doc_id), len([x for x in (r.text or "").split("\n") if edge.words(x)]),
                       want.get((last if r.doc_id is None else r.doc_id, r.text or ""), [])) for r in rows)
    got = line_dedup.line_report(df).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.removed_lines) for r in got) == expected
    assert all(r.n_removed == len(r.removed_lines) for r in got)
    return sum(len(x[2]) for x in expected)


def test_lines_of_documents(spark, sf):
    assert check_lines(spark.read.parquet(f"{sf}/documents.parquet")) > 50


def test_lines_of_hard_rows(spark):
    assert check_lines(edge.table(spark).repartition(3)) > 0
    assert line_dedup.line_report(edge.empty(spark)).count() == 0


def test_near_lines_near_the_threshold(spark):
    r = random.Random(5)
    base = [f"w{r.randint(0, 400)}" for _ in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            w[r.randrange(len(w))] = f"x{r.randint(0, 30)}"
        w = w[:r.choice([60, 60, 59, 52, 48])]
        rows.append((i, " ".join(w) + "\n" + " ".join(w[:r.choice([3, 5, 8])]) + f"\nown line {i} of few words here"))
    r.shuffle(rows)
    assert check_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) > 100


def test_texts_without_repeats(spark):
    df = edge.table(spark)
    want, last = removed(df.collect()), (1 << 63) - 1
    out = line_dedup.without_repeats(df, chars_col="n_chars")
    assert out.schema == df.schema or out.columns == df.columns
    expected = []
    for r in df.collect():
        gone = want.get((last if r.doc_id is None else r.doc_id, r.text or ""))
        expected.append((str(r.doc_id), r.text if not gone else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone)))
    got = out.collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((a, str(b)) for a, b in expected)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert line_dedup.without_repeats(edge.empty(spark)).count() == 0


def test_prefix_and_position_filters_lose_nothing():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = rng.choice(60, rng.integers(1, 40), replace=False)
        y = x.copy()
        y = np.unique(np.concatenate([rng.choice(y, max(1, len(y) - rng.integers(0, 4)), replace=False), rng.choice(60, rng.integers(0, 4))]))
        x = np.sort(x)
        if 5 * len(np.intersect1d(x, y)) < 4 * len(np.union1d(x, y)):
            continue
        px, py = (s[:len(s) - int(line_dedup.needed(np.array(len(s)), line_dedup.SIMILAR)) + 1] for s in (x, y))
        shared = np.intersect1d(px, py)
        assert len(shared)
        for t in shared:
            assert line_dedup.passes(np.array(len(x)), np.searchsorted(x, t), np.array(len(y)), np.searchsorted(y, t), line_dedup.SIMILAR)


def fingerprint(text):
    w = edge.words(edge.lowered(text))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(prints, distance=4):
    fp, group = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i] ^ fp) <= distance):
            a, b = find(i), find(int(j))
            group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fp))]


def check_simhash(df):
    rows = df.collect()
    prints = [fingerprint(r.text) for r in rows]
    group, least = reachable(prints), {}
    for g, r in zip(group, rows, strict=True):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", str(least.get(g))) for r, p, g in zip(rows, prints, group, strict=True))
    got = simhash.near_groups(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    return {str(x) for x in least.values()}


def test_simhash_of_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    stay = check_simhash(df)
    out = simhash.near_dedup(df)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == sorted(stay)


def test_simhash_of_hard_rows(spark):
    stay = check_simhash(edge.table(spark))
    out = simhash.near_dedup(edge.table(spark)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(stay)
    assert simhash.near_groups(edge.empty(spark)).count() == 0 and simhash.near_dedup(edge.empty(spark)).count() == 0


def test_one_of_near_copies_stays_whatever_their_ids(spark):
    far = " ".join(f"word{k}" for k in range(60))
    rows = [(None, ""), (None, " "), (None, "\t"), (None, " "), (None, far), (None, far)]  # no words: one fingerprint
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 2 and {r.text for r in kept} > {far}
    shared = spark.createDataFrame([(5, ""), (5, " "), (5, " "), (7, "\t"), (None, None)], "doc_id long, text string")
    kept = simhash.near_dedup(shared).collect()
    assert len(kept) == 1 and kept[0].doc_id == 5


@pytest.mark.parametrize("flips", [1, 2, 3, 4])
def test_links_of_planted_fingerprints(spark, flips):
    rng = np.random.default_rng(flips)
    v = rng.integers(-2**63, 2**63 - 1, 400, dtype=np.int64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False)) for x in v.view(np.uint64)]
    points = np.unique(np.concatenate([v, np.array(near, np.uint64).view(np.int64)]))
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in points], "fp long").repartition(3))
    roots = {r.a: r.b for r in components.component_roots(edges).collect()}
    got = [roots.get(int(x), int(x)) for x in points]
    want = reachable(points.view(np.uint64).tolist())
    assert len({*zip(got, want, strict=True)}) == len(set(got)) == len(set(want))


def test_codes_cover():
    rng = np.random.default_rng(2)
    v = rng.integers(-2**63, 2**63 - 1, 500, dtype=np.int64)
    for k, (first, bits, _, radius) in enumerate(simhash.SEGMENTS):
        row, key = simhash.anchors(v, k, simhash.code(k, 4))
        own = (v.view(np.uint64)[row] >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)
        apart = np.bitwise_count((own ^ (key & ((1 << bits) - 1))).astype(np.uint64))
        assert apart.max() == radius + 1 and all((apart[row == i] <= radius).sum() == 1 for i in range(100))


def test_dense_and_chained_groups_stay_connected():
    base = np.uint64(0x0123456789ABCDEF)
    dense = np.array([base ^ np.uint64(1 << i) for i in range(64)] + [base ^ np.uint64(3 << i) for i in range(60)], np.uint64)
    chain = np.array([(1 << 4 * k) - 1 for k in range(1, 13)], np.uint64)
    nodes, roots = simhash.forest(np.concatenate([dense, chain]).view(np.int64), 4)
    assert len(nodes) < len(dense) + len(chain)
    group = {int(x): int(x) for x in np.concatenate([dense, chain]).view(np.int64)}
    group.update(zip(nodes.tolist(), roots.tolist(), strict=True))
    assert len({group[int(x)] for x in dense.view(np.int64)}) == 1 and len({group[int(x)] for x in chain.view(np.int64)}) == 1


def test_tokens_of_chosen_lines_only():
    texts = pa.array(["a b c d e f\n\nx y\na b c d e f", None, "x y\nq r s t u v w", ""])
    row, number, h1, _, owner, token = next(line_dedup.LineHasher().lines(texts))
    assert row.tolist() == [0, 0, 0, 2, 2] and number.tolist() == [0, 2, 3, 0, 1]
    new = line_dedup.FirstSeen()
    *_, h1_again, _, own, some = next(line_dedup.LineHasher().lines(texts, new))
    assert (h1 == h1_again).all() and sorted(own.tolist()) == [0, 0, 1, 4, 4, 4]
    assert sorted(some) == sorted(token[np.isin(owner, [0, 1, 4])])
    assert not new(h1).any()
    assert new(np.array([1, 1, 2], np.uint64), np.array([False, False, True])).tolist() == [False, False, True]


@pytest.mark.parametrize("lines", [50, 100_000])
def test_tokens_ranked_as_by_a_full_sort(lines):
    rng = np.random.default_rng(lines)
    owner, token = rng.integers(0, lines, 5_000), rng.integers(0, 1 << 63, 300, dtype=np.uint64)[rng.integers(0, 300, 5_000)]
    cells = rng.integers(0, 3, 1 << line_dedup.CELL_BITS)
    got = line_dedup.ranked(owner, token, line_dedup.rarity(cells))
    want = sorted({(int(o), int(cells[int(t) >> 48]), int(t)) for o, t in zip(owner, token, strict=True)})
    assert [(o, t) for o, _, t in want] == list(zip(got[0].tolist(), got[1].tolist(), strict=True))


def test_removed_lines_need_no_join_of_all_lines(spark, monkeypatch):
    rows, made = [(k, "a b c d e f\nown line %d of it here" % k) for k in range(20)], []
    written = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: made.append(name) or written(df, name))
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.removed_lines for r in got] == [[], *[[0]] * 19] and {r.n_lines for r in got} == {2}
    assert made.count("classes") == 1


def test_tables_of_the_line_join_are_deleted_once_read(spark):
    import pathlib
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "lendwise-llm"
    names = ("lines", "classes", "postings", "wanted", "sets", "posted", "pairs", "settled", "rest", "matched")

    def held():
        return {p for name in names for p in root.glob(f"*/{name}")}

    before = held()
    line = " ".join(f"w{k}" for k in range(40))
    rows = [(1, line), (2, line + " x"), (3, "y " + line), (4, "other words of a line\nand more"), (5, line)]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.removed_lines for r in got] == [[], [0], [0], [], [0]]
    assert {p.name for p in held() - before} == {"lines", "classes", "matched"}
