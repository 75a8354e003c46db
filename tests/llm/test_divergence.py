"""Source divergence against brute force over dense counts."""

import collections
import random
import re

import numpy as np
import pytest

import edge
from lendwise.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, min_docs, top=50):
    docs = [(r.lang or "", r.source or "", TERM.findall(edge.lowered(r.text))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, whole, by = collections.Counter(), collections.Counter(), collections.defaultdict(collections.Counter)
        for _, source, words in (d for d in docs if d[0] == lang):
            df.update(set(words))
            whole.update(words)
            by[source].update(words)
        kept = [t for t in df if df[t] >= min_docs]
        v = len(kept)

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (n + 5 * v) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in by.items()}
        for s in by:
            pairs = [(-sum(abs(p[s][t] - p[r][t]) for t in kept), r.encode(), r) for r in by if r != s]
            terms = [(-(p[s][t] - q[t]), t.encode(), t) for t in kept if by[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, x, -f, k + 1) for k, (f, _, x) in enumerate(items)]
    return sorted(out)


def check(df, min_docs, **options):
    got = sorted(tuple(r) for r in divergence.audit(df, min_docs, **options).collect())
    assert got == audited(df.collect(), min_docs, **options)
    return got


@pytest.mark.parametrize("min_docs", [1, 2, 50])
def test_hard_rows(spark, min_docs):
    check(edge.table(spark).repartition(3), min_docs)


def test_documents_and_none(spark, sf):
    assert len(check(spark.read.parquet(f"{sf}/documents.parquet"), 5)) > 500
    assert divergence.audit(edge.empty(spark)).count() == 0


def rows_of_many_sources(n=400, seed=1):
    r = random.Random(seed)
    texts = [" ".join(r.choice("alpha beta gamma delta Äpfel über 日本 x-y z'z".split()) + r.choice(["", "", str(r.randint(0, 9))]) for _ in range(r.randint(0, 30))) for _ in range(120)]
    return [(r.choice(["en", "de", None]), f"s{r.randint(0, 25)}" if r.random() > 0.3 else None, r.choice(texts)) for _ in range(n)]


def test_copies_blocks_and_shards(spark, monkeypatch):
    """Many copies across sources; blocks of three sources, shards of fifty rows, small memory in tasks."""
    for name, value in (("BLOCK", 3), ("SHARD_ROWS", 50), ("FLUSH", 20)):
        monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame(rows_of_many_sources(), "lang string, source string, text string").repartition(5)
    check(df, 3, top=4)


def test_every_text_may_go_the_way_of_copies(spark, monkeypatch):
    """A full bitmap changes the way, not the result."""
    df = spark.createDataFrame(rows_of_many_sources(60), "lang string, source string, text string")
    want = check(df, 2)
    monkeypatch.setattr(divergence, "copied_bitmap", lambda rows: np.full(8, 255, np.uint8))
    assert check(df, 2) == want


def test_a_text_is_tokenized_once(spark):
    """Texts that occur twice or more never reach the first tokenizer, others never the second."""
    df = spark.createDataFrame([("en", "a", "one two"), ("en", "b", "one two"), ("en", "a", "three"), ("de", "a", "one two")], "lang string, source string, text string")
    found, groups = divergence.postings(df)
    got = sorted((r.lang, r.term, r.source, r["count"], r.docs) for r in found.collect())
    assert got == [("de", "one", "a", 1, 1), ("de", "two", "a", 1, 1), ("en", "one", "a", 1, 1), ("en", "one", "b", 1, 1),
                   ("en", "three", "a", 1, 1), ("en", "two", "a", 1, 1), ("en", "two", "b", 1, 1)]
    assert groups.count() == 3
