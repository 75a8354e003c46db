"""Class language model and quality classifier."""

import collections
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import edge
from lendwise.llm import class_lm, quality_classifier
from lendwise.llm.ngrams import TokenHasher


def tokens(text):
    return edge.words(edge.lowered(text)) + ["\n"]


def is_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check_counts(df, **options):
    rows = df.collect()
    c = collections.Counter(w for r in rows if not is_out(r.doc_id) for w in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = sorted((str(r.doc_id), is_out(r.doc_id), len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 5)) for r in rows for t in [tokens(r.text)])
    got = class_lm.score(df, **options).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    return got


@pytest.fixture(scope="module")
def scored(spark, sf):
    return check_counts(spark.read.parquet(f"{sf}/documents.parquet"), block_bytes=100_000, frequent=2_000)


def test_model_beats_unigrams_on_held_out_documents(scored):
    out = [r for r in scored if r.held_out]
    assert len(out) > 10 and sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens)) for r in out)


def test_blocks_do_not_matter(spark, sf, scored):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    other = {r.doc_id: r for r in class_lm.score(df.repartition(3), frequent=2_000).collect()}
    assert all(math.isclose(r.score, other[r.doc_id].score, rel_tol=1e-9) for r in scored)


def test_scores_of_hard_rows(spark):
    got = check_counts(edge.table(spark), block_bytes=1_000)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert class_lm.score(edge.empty(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    out = next(i for i in range(100) if is_out(i))
    got = class_lm.score(spark.createDataFrame([(out, "a b"), (out, None)], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    top, frequent = 1 + 3 + 64, 7
    classes = class_lm.first_classes(frequent, 3)
    counts = {0: 5, **{s: int(rng.integers(3, 9)) for s in range(1, frequent)}}
    words = [(s, c) for s, c in counts.items()] + [(class_lm.BAND + 1, 2), (class_lm.BAND + 1, 3), (class_lm.ONCE, 1), (class_lm.ONCE, 1)]
    stream = rng.permutation([s for s, c in words for _ in range(c)])
    matrix = np.zeros((top, top))
    np.add.at(matrix, (classes[np.append(0, stream[:-1])], classes[stream]), 1)
    transition, emission = class_lm.probabilities(matrix, classes, 2)
    for v in range(top):
        p = [10 ** (transition[v, classes[s]] + emission[s] + math.log10(c)) for s, c in words]
        p.append(10 ** (transition[v, classes[class_lm.UNKNOWN]] + emission[class_lm.UNKNOWN]))
        # Classes without a word keep a little smoothed mass; all else is shared out.
        empty = sum(10 ** transition[v, k] for k in range(top) if k not in {classes[s] for s, _ in words})
        assert math.isclose(sum(p) + empty, 1, rel_tol=1e-9)


def test_exchange_raises_the_likelihood(spark):
    r = np.random.default_rng(6)
    docs = []
    for i in range(300):  # determiner noun verb, each from its own list
        docs.append((i, " ".join(f"d{r.integers(6)} n{r.integers(12)} v{r.integers(9)}" for _ in range(20))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    documents, totals = class_lm.encoded(class_lm.staged(df, "doc_id", "text", 7, 2, 1 << 20), 1_000)
    pairs = class_lm.bigrams(documents)
    start, _ = class_lm.class_counts(pairs, class_lm.first_classes(totals["frequent"], 3), 1 + 3 + 64, totals["frequent"])
    _, matrix = class_lm.exchanged(pairs, totals["frequent"], 3, 8)
    assert class_lm.likelihood(matrix) > class_lm.likelihood(start)
    assert matrix.sum() == start.sum() == totals["tokens"]


def test_every_word_seen_often_enough_is_clustered(spark):
    docs = [(i, " ".join(["the"] * 4_000 + [f"w{k}" for k in range(300)])) for i in range(60)]  # each w is 1 of 4,300 words
    df = spark.createDataFrame([*docs, (100, "rare rare x")], "doc_id long, text string")
    _, totals = class_lm.encoded(class_lm.staged(df, "doc_id", "text", 7, 2, 1 << 20))
    assert totals["tokens"] > 5 * 40_000 and totals["frequent"] == 1 + 301
    _, low = class_lm.encoded(class_lm.staged(df, "doc_id", "text", 7, 2, 1 << 20), least=2)
    assert low["frequent"] == 1 + 301 + (not is_out(100))


def test_more_words_than_16_bits(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(35_000 * (i % 2), 35_000 * (i % 2 + 1)))) for i in range(16)],
                               "doc_id long, text string")
    got = check_counts(df, rounds=1, block_bytes=1 << 20)
    documents, totals = class_lm.encoded(class_lm.staged(df, "doc_id", "text", 7, 2, 1 << 20))
    seen = {s for r in documents.collect() for s in np.frombuffer(zlib.decompress(r.symbols), "<i4").tolist()}
    assert totals["frequent"] == 70_001 and seen == set(range(70_001)) and all(math.isfinite(r.score) for r in got)
    assert class_lm.class_number(totals["frequent"]) == 83 and class_lm.class_number(1_000) == 64


def test_best_classes_against_brute_force():
    rng = np.random.default_rng(8)
    n_classes, v = 4, 30
    top = 1 + n_classes + 64
    classes = class_lm.first_classes(v, n_classes)
    stream = np.append(0, rng.integers(-2, v, 400) // rng.integers(1, 4, 400))
    pairs = collections.Counter(zip(stream[:-1].tolist(), stream[1:].tolist()))

    def matrix_of(classes):
        m = np.zeros((top, top))
        for (a, b), n in pairs.items():
            m[classes[a], classes[b]] += n
        return m

    around = collections.Counter()
    for (a, b), n in pairs.items():
        if a > 0:
            around[a, int(classes[b])] += n
        if b > 0:
            around[b, top + int(classes[a])] += n
    word, k, n = (np.array(x) for x in zip(*[(*key, n) for key, n in sorted(around.items())]))
    words, best = class_lm.best_classes(word, k, n, classes, matrix_of(classes), n_classes)
    for w, chosen in zip(words, best, strict=True):
        if pairs[w, w]:  # a word after itself: the gain takes its other end as staying
            continue
        values = []
        for c in range(1, n_classes + 1):
            other = classes.copy()
            other[w] = c
            values.append(class_lm.likelihood(matrix_of(other)))
        assert math.isclose(values[chosen - 1], max(values), rel_tol=1e-12)


def test_scores_by_brute_force(spark, sf):
    """Class bigrams are counted again from the words; the operator's own part in it is the classes alone."""
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rounds, n_classes = 2, 5
    got = {r.doc_id: r.score for r in class_lm.score(df, classes=n_classes, rounds=rounds).collect()}
    documents, totals = class_lm.encoded(class_lm.staged(df, "doc_id", "text", 7, 2, 1 << 20))
    class_of, _ = class_lm.exchanged(class_lm.bigrams(documents), totals["frequent"], n_classes, rounds)
    rows = df.collect()
    symbols = {r.id: np.frombuffer(zlib.decompress(r.symbols), "<i4").tolist() for r in documents.collect()}
    known = collections.Counter(w for r in rows if not is_out(r.doc_id) for w in tokens(r.text))
    word_class = {}
    for r in rows:
        for w, s in zip(tokens(r.text), symbols[r.doc_id], strict=True):
            assert word_class.setdefault(w, int(class_of[s])) == class_of[s]
    assert len({word_class[w] for w, c in known.items() if c >= 5 and w != "\n"}) == n_classes and word_class["\n"] == 0
    follow, size = collections.Counter(), collections.Counter()
    for r in rows:
        if not is_out(r.doc_id):
            line = [0] + [word_class[w] for w in tokens(r.text)]
            follow.update(zip(line[:-1], line[1:]))
            size.update(line[1:])
    top, once = 1 + n_classes + 64, sum(c == 1 for c in known.values())
    total = sum(size.values())
    leaving = collections.Counter()
    for (v, _), n in follow.items():
        leaving[v] += n

    def log_p(v, w):
        k, c = word_class[w], known[w]
        step = (follow[v, k] + 10.0 * (size[k] + 1) / (total + top)) / (leaving[v] + 10.0)
        return math.log10(step * (c / size[k] if c > 1 else 0.5 / once if c == 1 else 0.5))

    for r in rows:
        words = tokens(r.text)
        want = sum(log_p(v, w) for v, w in zip([0] + [word_class[w] for w in words[:-1]], words, strict=True))
        assert math.isclose(got[r.doc_id], want, rel_tol=1e-9), r.doc_id


def test_merged_counts():
    rng = np.random.default_rng(12)
    for low, high in ((-50, 50), (-(1 << 62), 1 << 62), (7, 8)):
        key, n = rng.integers(low, high, 3_000), rng.integers(1, 1 << 40, 3_000)
        own, sums = class_lm.merged(key, n)
        want = collections.Counter()
        for k, m in zip(key.tolist(), n.tolist(), strict=True):
            want[k] += m
        assert own.tolist() == sorted(want) and sums.tolist() == [want[k] for k in sorted(want)]
    assert [len(x) for x in class_lm.merged(key[:0], n[:0])] == [0, 0]


@pytest.mark.parametrize("times", [1, 7, 8, 9, 40])
def test_gains_of_few_and_many_occurrences(times):
    """Counts on both sides of FEW: the best class against the likelihood of each move."""
    rng = np.random.default_rng(times)
    n_classes, v = 4, 14
    top, classes = 1 + n_classes + 64, class_lm.first_classes(v, n_classes)
    pairs = {(a, b): times * int(rng.integers(1, 4)) for a in range(v) for b in range(v) if a != b and rng.random() < 0.4}

    def matrix_of(classes):
        m = np.zeros((top, top))
        for (a, b), n in pairs.items():
            m[classes[a], classes[b]] += n
        return m

    around = collections.Counter()
    for (a, b), n in pairs.items():
        if a:
            around[a, int(classes[b])] += n
        if b:
            around[b, top + int(classes[a])] += n
    word, k, n = (np.array(x) for x in zip(*[(*key, n) for key, n in sorted(around.items())]))
    for w, chosen in zip(*class_lm.best_classes(word, k, n, classes, matrix_of(classes), n_classes), strict=True):
        values = []
        for c in range(1, n_classes + 1):
            other = classes.copy()
            other[w] = c
            values.append(class_lm.likelihood(matrix_of(other)))
        assert math.isclose(values[chosen - 1], max(values), rel_tol=1e-12)


def test_tables_that_are_read_are_deleted(spark, sf):
    import pathlib
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "lendwise-llm"

    def held(*names):
        return {p for name in names for p in root.glob(f"*/{name}")}

    before = held("staged", "words", "bigrams", "encoded")
    assert class_lm.score(spark.read.parquet(f"{sf}/documents.parquet").limit(30), rounds=1).count() == 30
    assert {p.name for p in held("staged", "words", "bigrams", "encoded") - before} == {"encoded"}


def test_token_hashes_depend_on_tokens_only():
    hasher = TokenHasher()
    texts = ["Ab, ab!! x", "zz AB,ab !! x", "", None, "ab"]
    out = {}
    for a, b, buckets, owner in hasher.ngram_buckets(pa.array(texts), 1 << 40, span=4):
        for k in range(a, b):
            out[k] = sorted(buckets[owner == k - a].tolist())
    whole = {}
    for a, b, buckets, owner in hasher.ngram_buckets(pa.array(texts), 1 << 40):
        for k in range(a, b):
            whole[k] = sorted(buckets[owner == k - a].tolist())
    assert out == whole and len(whole[0]) == 9 and not whole[2] and not whole[3]
    assert set(whole[0]) < set(whole[1]) | set(whole[0]) and set(whole[4]) < set(whole[0])


@pytest.mark.parametrize(("scale", "half"), [("sf0.001", 0), ("sf0.001", 1), ("sf0.01", 0), ("sf0.01", 1)])
def test_classifier_separates_held_out_labels(spark, scale, half):
    """Fitted on half of the labels; of the other half nearly all clean documents stay, and most bad ones go."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{scale}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.resample(docs, labels.filter(f"doc_id % 2 = {half}"))
    assert got.count() == docs.count()
    held = labels.filter(f"doc_id % 2 = {1 - half} and toxic = 0")
    seen = got.join(held, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in seen}
    assert share[1] > 0.97 and share.get(0, 0) < 0.5


def test_few_labels_reject_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    few = labels.filter("quality = 1 and toxic = 0").limit(3).union(labels.filter("quality = 0").limit(3))
    assert quality_classifier.accepted(docs, few).count() == docs.count()


def xx(value, seed):
    return xxhash.xxh64_intdigest(value if isinstance(value, bytes) else value.to_bytes(8, "little", signed=True), seed)


def test_ratios_weights_and_draws_by_brute_force(spark, sf):
    """Counts in dictionaries, one text at a time; noise from the hashes' definition."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_classifier.resample(docs, labels).collect()}
    rows, label = docs.collect(), {r.doc_id: r for r in labels.collect()}
    size, pseudo = quality_classifier.BUCKETS, quality_classifier.PSEUDO
    grams, target, raw = {}, collections.Counter(), collections.Counter()
    for r in rows:
        found = [b.tolist() for _, _, b, _ in TokenHasher().ngram_buckets(pa.array([r.text]), size)]
        grams[r.doc_id] = [x for part in found for x in part]
        raw.update(grams[r.doc_id])
        if r.doc_id in label and label[r.doc_id].quality == 1 and label[r.doc_id].toxic == 0:
            target.update(grams[r.doc_id])
    nt, nr = sum(target.values()) + pseudo * size, sum(raw.values()) + pseudo * size
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for r in rows:
        g = grams[r.doc_id]
        mean = sum(math.log((target[b] + pseudo) / nt) - math.log((raw[b] + pseudo) / nr) for b in g) / max(1, len(g))
        text_hash = signed(xx(r.text.encode(), 42))
        toss = (signed(xx(text_hash, xx(r.doc_id, xx(quality_classifier.SEED, 42)))) % (1 << 53) + 0.5) / (1 << 53)
        seen = got[r.doc_id]
        assert math.isclose(seen.log_ratio, mean, abs_tol=1e-9) and math.isclose(seen.log_weight, 200 * mean, abs_tol=1e-6)
        assert math.isclose(seen.draw, 200 * mean - math.log(-math.log(toss)), abs_tol=1e-6)
    least = min(r.draw for r in got.values() if r.kept)
    assert all(r.kept == (r.draw >= least) for r in got.values())


def test_toxic_labels_are_bad_when_the_cutoff_is_chosen(spark):
    rng = np.random.default_rng(11)
    docs = [(i, " ".join(rng.choice([f"{'vile' if i % 4 == 0 else 'fair'}{k}" for k in range(20)], 40))) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in docs], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_classifier.resample(df, labels).collect() if r.kept}
    assert kept == {i for i, _ in docs if i % 4}


def test_classifier_draws_k_of_n(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    classifier = quality_classifier.Classifier(docs, labels, k=50)
    rows = classifier.report().collect()
    top = sorted((r.draw for r in rows), reverse=True)
    assert classifier.least == top[49] and all(r.kept == (r.draw >= top[49]) for r in rows)
    kept = classifier.accepted(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)


def test_kth_draw_of_many_rows(spark):
    scores = spark.range(30_000).select((F.col("id") * 7919 % 30_011 / 10 - 500).alias("draw")).repartition(3)
    ordered = sorted((r.draw for r in scores.collect()), reverse=True)
    for k in (1, 2_500, 17_000, 29_999, 30_000):
        assert quality_classifier.least_draw(scores, k) == ordered[k - 1]
    assert quality_classifier.least_draw(scores, 0) == math.inf
    assert quality_classifier.least_draw(spark.createDataFrame([(1.0,)] * 5_000, "draw double"), 2_600) == 1.0


def test_classifier_on_hard_rows(spark):
    df = edge.table(spark)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, 1, None), (7, 0, 1), (None, 1, 0), (11, None, 0)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0)):
        assert quality_classifier.resample(df, own).count() == df.count()
        assert quality_classifier.accepted(df, own).columns == df.columns
    assert quality_classifier.accepted(df, labels.limit(0)).count() == df.count()  # nothing is known, nothing rejected
    assert quality_classifier.resample(edge.empty(spark), labels).count() == 0
    assert quality_classifier.accepted(edge.empty(spark), labels).count() == 0


def test_words_numbered_as_the_pattern_finds_them():
    texts = ["".join(f"A{chr(c)}Bq" for c in range(256)), None, "", " \t x", "\u00c9 b\x1c\x85\u00c4  ", "\n\n", "x X x"]
    for chunks in ([texts], [texts[:3], texts[3:]]):
        seq, ends, names = class_lm.numbered_words(pa.chunked_array(chunks, pa.string()))
        names = names.to_pylist()
        got = [[names[k] for k in seq[a:b]] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert got == [tokens(t) for t in texts] and len(set(names)) == len(names)


def test_bigrams_of_a_word_lie_together(spark, monkeypatch):
    """All that a word occurs with is in one row, so that rounds shuffle no contexts but those of the most frequent words."""
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 300, 200))) for k in range(60)]
    documents, totals = class_lm.encoded(class_lm.staged(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 7, 2, 4_000))
    assert totals["frequent"] == 301
    want = collections.Counter()
    for r in documents.filter("not held_out").collect():
        seq = [0, *np.frombuffer(zlib.decompress(r.symbols), "<i4").tolist()]
        want.update(zip(seq[:-1], seq[1:]))
    monkeypatch.setattr(class_lm, "PART_BITS", 9)
    made = class_lm.bigrams(documents).collect()
    assert len(made) > 20
    first, second, places = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for at, r in enumerate(made):
        for word, other, n, found in ((r.word_a, r.other_a, r.n_a, first), (r.word_b, r.other_b, r.n_b, second)):
            word, other = (np.frombuffer(x, "<i4").tolist() for x in (word, other))
            for v, w, m in zip(word, other, class_lm.unpacked(bytes(n), len(word)).tolist(), strict=True):
                assert r.hot == (v <= class_lm.HOT) and r.half == (-1 if v <= 0 else 0 if class_lm.own_turn(np.array([v]), 0)[0] else 1)
                found[(v, w) if found is first else (w, v)] += m
                places[v].add(at)
    assert first == want and second == {k: n for k, n in want.items() if k[1] > 0}
    assert all(len(places[v]) == 1 for v in range(class_lm.HOT + 1, 301)) and len(places[1]) > 1


def peak_of(run):
    tracemalloc.start()
    try:
        made = run()
        return made, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_numbering_a_block_holds_little_beside_its_numbers():
    texts = pa.chunked_array([[f"abcdefg {k} " * 1000 for k in range(500)], [f"hijklmn {k} " * 1000 for k in range(500)]], pa.string())
    (seq, ends, names), peak = peak_of(lambda: class_lm.numbered_words(texts))
    assert len(seq) == 2_001_000 and len(ends) == 1000 and len(names) == 503
    assert peak < 16 * len(seq)  # it was 28 bytes a token
    n, peak = peak_of(lambda: class_lm.counted((seq[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)), len(names)))
    assert n.tolist() == np.bincount(seq).tolist() and peak < 8 * len(seq)


def test_dealing_bigrams_holds_little_beside_them():
    rng = np.random.default_rng(5)
    pair = rng.integers(-5, 2000, 1 << 20) << 32 | rng.integers(-5, 2000, 1 << 20) & 0xFFFFFFFF
    want = collections.Counter(zip((pair >> 32).tolist(), pair.astype(np.int32).tolist()))
    held = pair.nbytes
    batches, peak = peak_of(lambda: sum(b.num_rows for b in class_lm.dealt(pair.copy(), 300)))
    assert batches > 500 and peak < 5.5 * held
    first, second = collections.Counter(), collections.Counter()
    for b in class_lm.dealt(pair, 300):
        for r in b.to_pylist():
            pairs = np.frombuffer(r["pairs"], np.int64)
            word, other = pairs >> 32, pairs.astype(np.int32).astype(np.int64)
            assert set(class_lm.parts_of(word, other, 300)) == {r["part"]} and (not r["before"] or word.min() > 0)
            own = zip(other.tolist(), word.tolist()) if r["before"] else zip(word.tolist(), other.tolist())
            (second if r["before"] else first).update(dict(zip(own, class_lm.unpacked(r["n"], len(pairs)).tolist())))
    assert first == want and second == {k: n for k, n in want.items() if k[1] > 0}
