"""Quality classifier by importance resampling.

Two bag-of-hashed-n-grams models (unigrams and bigrams of lowered tokens, in
``buckets`` hash buckets): one of target texts, one of all raw texts. The log
importance of a text is its mean log ratio of the two models per n-gram, times
``scale``, so that a text's length alone does not decide; its draw is that plus Gumbel noise, a hash of
(seed, id, text). The ``k`` highest draws are a sample of k texts without
replacement with probabilities that follow their importance.

The target model is fitted on labelled rows: those of quality 1 and not toxic,
at most ``max_labels``, the first by a hash of the id. The raw model counts
all documents. Unless k is given, it is the number of documents whose mean log
ratio reaches the cutoff that best separates labelled good from bad rows. A fitted text scores
higher than any other, so the cutoff is cross-fitted: labels fall into ``FOLDS`` by a hash
of the id, and each labelled text is scored by the model of the other folds. The
share of good texts lost at a cutoff is that of their held-out scores smoothed by a Gaussian kernel, so that
few labels do not cut at their own extreme.

Defined results: null and empty texts have importance 0; very long texts are scored whole; an id with several
labels is good only if all say so; without good or without bad labels, or with fewer than ``FOLDS`` good ones, nothing
is rejected; repeated rows and equal draws are kept or rejected together; an empty
table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import forget_held, new_names, released, written
from lendwise.llm.ngrams import TokenHasher

BUCKETS, SCALE, SEED, MAX_LABELS, PSEUDO, FOLDS = 10_000, 200.0, 8, 20_000, 0.5, 5
#: A bad label weighs so little against a good one when the cutoff is chosen: clean documents stay.
BAD_WEIGHT = 0.01


def labelled(labels: DataFrame, id_col: str, quality_col: str, toxic_col: str | None, max_labels: int) -> DataFrame:
    """(label_id, good, toxic, fold): at most ``max_labels`` rows, the first by a hash of the id."""
    good = F.min((F.col(quality_col) == 1).cast("int"))
    bad = F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False)).cast("int")) if toxic_col else F.lit(0)
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
    rows = rows.agg(good.alias("good"), bad.alias("toxic"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(2), "label_id"), F.lit(FOLDS)).cast("int"))
    return written(rows.orderBy(F.xxhash64(F.lit(1), "label_id"), "label_id").limit(max_labels), "labels")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """n-gram counts per bucket of rows (fold, text): of the target texts of each fold, then of
    all texts; collects one row per bucket."""
    def count(batches):
        forget_held()
        hasher, counts = TokenHasher(), np.zeros((FOLDS + 1, buckets), np.int64)
        for b in batches:
            fold = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, end, bucket, owner in hasher.ngram_buckets(b.column(1), buckets):
                counts[FOLDS] += np.bincount(bucket, minlength=buckets)
                of = fold[first:end][owner]
                for k in np.unique(of[of >= 0]):
                    counts[k] += np.bincount(bucket[of == k], minlength=buckets)
        used = np.flatnonzero(counts[FOLDS])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(c[used]) for c in counts]], ["bucket", *names])

    names = [f"n{k}" for k in range(FOLDS + 1)]
    found = rows.mapInArrow(released(count), "bucket long, " + ", ".join(f"{n} long" for n in names)).groupBy("bucket").agg(
        *[F.sum(n).alias(n) for n in names]).collect()
    counts = np.zeros((FOLDS + 1, buckets))
    for r in found:
        counts[:, r["bucket"]] = [r[n] for n in names]
    return counts


def best_cutoff(good: np.ndarray, bad: np.ndarray) -> float:
    """The mean log ratio from which on texts count as good: the split of the
    labelled rows with the least weighted error, halfway between neighbours. The good
    rows' share below a split is smoothed by a Gaussian kernel (Silverman's width)."""
    if len(good) < FOLDS or not len(bad):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    spread = np.subtract(*np.percentile(good, [75, 25])) / 1.34
    width = 0.9 * min(good.std(), spread or good.std()) * len(good) ** -0.2 + 1e-12
    values = np.unique(np.concatenate([good, bad]))
    cuts = (values[1:] + values[:-1]) / 2
    cuts = cuts[np.searchsorted(good, cuts) <= 2 * BAD_WEIGHT * len(good) + 1]  # above, half a weight of good texts is lost: more than by keeping all
    lost = np.array([below(good, c, width) for c in cuts]) / len(good)
    passed = 1 - np.searchsorted(bad, cuts) / len(bad)
    error = np.append(BAD_WEIGHT, lost + BAD_WEIGHT * passed)  # the first keeps everything
    return float(np.append(-np.inf, cuts)[np.argmin(error)])


def below(good: np.ndarray, cut: float, width: float) -> float:
    """How many of the sorted values lie below the cut, each smoothed over ``width``."""
    a, b = np.searchsorted(good, [cut - 6 * width, cut + 6 * width])  # farther ones are all or nothing
    return a + sum(0.5 * math.erfc((x - cut) / width / math.sqrt(2)) for x in good[a:b].tolist())


def mean_ratios(hasher: TokenHasher, texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio per n-gram of each text; 0 where there is none."""
    out = np.zeros(len(texts))
    for first, end, bucket, owner in hasher.ngram_buckets(texts, len(ratio)):
        n = np.bincount(owner, minlength=end - first)
        out[first:end] = np.bincount(owner, ratio[bucket], end - first) / np.maximum(n, 1)
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the target and raw models per bucket (all zero without target texts)."""
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + PSEUDO) / (target.sum() + PSEUDO * len(raw))) - np.log((raw + PSEUDO) / (raw.sum() + PSEUDO * len(raw)))


def fitted(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(log ratio per bucket, the same per fold without the fold's own texts)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), F.col("id") == F.col("label_id"), "left")  # at most max_labels rows of 16 bytes
    target = F.when((F.col("good") == 1) & (F.col("toxic") == 0), F.col("fold")).otherwise(-1)
    counts = bucket_counts(rows.select(target.cast("int").alias("fold"), "text"), buckets)
    own, raw = counts[:FOLDS], counts[FOLDS]
    return log_ratios(own.sum(axis=0), raw), np.array([log_ratios(own.sum(axis=0) - c, raw) for c in own])


def noise(id_col: Column, text_hash: Column, seed: int) -> Column:
    """Gumbel noise from a hash."""
    toss = (F.pmod(F.xxhash64(F.lit(seed).cast("long"), id_col, text_hash), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return -F.log(-F.log(toss))


def least_draw(scores: DataFrame, k: int) -> float:
    """The k-th highest ``draw``, found by narrowing its range in rounds of 1,024
    cells; at most a few thousand numbers reach the driver. Rows whose draws
    equal it stay together."""
    edges = scores.agg(F.min("draw").alias("lo"), F.max("draw").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, inside, above = edges["lo"], edges["hi"], edges["n"], 0
    if k <= 0 or not inside:
        return float("inf")
    if k >= inside:
        return lo
    while inside > 2_000 and hi > lo:  # ``above`` draws exceed hi, the k-th lies in [lo, hi]
        cell = F.least(F.floor((F.col("draw") - F.lit(lo)) / F.lit((hi - lo) / 1024)), F.lit(1023))
        cells = scores.filter(F.col("draw").between(lo, hi)).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("draw").alias("lo"), F.max("draw").alias("hi")).orderBy(F.desc("cell")).collect()
        for r in cells:
            if above + r["n"] >= k:
                break
            above += r["n"]
        if len(cells) == 1 and (r["lo"], r["hi"]) == (lo, hi):
            return lo  # a range too narrow to cut: its rows stay together
        lo, hi, inside = r["lo"], r["hi"], r["n"]
    if hi == lo:
        return lo
    draws = sorted((r["draw"] for r in scores.filter(F.col("draw").between(lo, hi)).select("draw").collect()), reverse=True)
    return draws[k - above - 1]


class Classifier:
    """Fitted on documents and labels: ``ratio`` per bucket, the slim ``scores``
    (written: id, log_ratio, log_weight, draw) and ``least``, the lowest accepted draw."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
                 scale: float = SCALE, seed: int = SEED, buckets: int = BUCKETS, max_labels: int = MAX_LABELS,
                 label_id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str | None = "toxic"):
        self.id_col, self.text_col, self.scale, self.seed = id_col, text_col, scale, seed
        known = labelled(labels, label_id_col, quality_col, toxic_col, max_labels)
        ratio, folds = fitted(docs, known, id_col, text_col, buckets)
        self.ratio = ratio

        def score(batches):
            hasher = TokenHasher()
            for b in batches:
                out, fold, texts = mean_ratios(hasher, b.column(3), ratio), b.column(2), b.column(3)
                held = np.full(len(out), np.nan)
                for k in fold.unique().drop_null().to_pylist():
                    at = np.flatnonzero(fold.fill_null(-1).to_numpy() == k)
                    held[at] = mean_ratios(hasher, texts.take(pa.array(at)), folds[k])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out), pa.array(held, from_pandas=True)],
                                                 ["id", "noise", "log_ratio", "held_ratio"])

        rows = docs.select(F.col(id_col).alias("id"), noise(F.col(id_col), F.xxhash64(F.col(text_col)), seed).alias("noise"),
                           F.col(text_col).cast("string").alias("text"))
        rows = rows.join(F.broadcast(known), F.col("id") == F.col("label_id"), "left").select("id", "noise", "fold", "text")
        scores = written(rows.mapInArrow(released(score), f"id {dict(rows.dtypes)['id']}, noise double, log_ratio double, held_ratio double"), "scores")
        weight = F.col("log_ratio") * scale
        self.scores = scores.select("id", "log_ratio", weight.alias("log_weight"), (weight + F.col("noise")).alias("draw"))
        self.cutoff = -np.inf
        if k is None:
            keep = F.when(F.col("toxic") == 1, 0).otherwise(F.col("good"))  # as in the fit
            seen = scores.filter("held_ratio is not null").join(F.broadcast(known), F.col("id") == F.col("label_id"))
            seen = seen.groupBy(keep.alias("good"), "held_ratio", "label_id").count().collect()  # at most max_labels ids
            split = [np.array([r["held_ratio"] for r in seen if r["good"] == g]) for g in (1, 0)]
            self.cutoff = best_cutoff(*split) if ratio.any() else -np.inf
            k = self.scores.filter(F.col("log_ratio") >= F.lit(float(self.cutoff))).count()
        self.least = least_draw(self.scores, k)

    def report(self) -> DataFrame:
        """One row per document: id, log_ratio, log_weight, draw, kept."""
        kept = (F.col("draw") >= F.lit(float(self.least))).alias("kept")
        return self.scores.select(F.col("id").alias(self.id_col), "log_ratio", "log_weight", "draw", kept)

    def accepted(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are drawn; scored where they are read, nothing is shuffled."""
        ratio, scale, least, text_at, noise_at = self.ratio, self.scale, self.least, docs.columns.index(self.text_col), len(docs.columns)
        own, = new_names(docs.columns, "noise")

        def keep(batches):
            hasher = TokenHasher()
            for b in batches:
                draw = mean_ratios(hasher, b.column(text_at), ratio) * scale + b.column(noise_at).to_numpy()
                yield pa.RecordBatch.from_arrays(b.columns[:-1], names).filter(pa.array(draw >= least))

        names = docs.columns
        rows = docs.withColumn(own, noise(docs[self.id_col], F.xxhash64(docs[self.text_col]), self.seed))
        return rows.mapInArrow(released(keep), docs.schema)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    return Classifier(docs, labels, id_col, text_col, **options).report()


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    return Classifier(docs, labels, id_col, text_col, **options).accepted(docs)
