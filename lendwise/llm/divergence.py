"""Source divergence audit: which sources of a language use its words differently.

1. Duplicate-text collapse. A first pass over slim rows (a 64-bit hash of lang
   and text) counts copies; the cells of hashes seen twice or more set a bit in a bitmap whose bits follow their number. In
   the second pass a text whose bit is clear occurs once: it is tokenized where it was read. Other
   texts are grouped by (lang, text) with a multiplicity per source, combined map-side, and
   tokenized once; document frequencies and counts are weighted by the multiplicities. A bit shared by
   chance sends a single text the second way, with the same result.
2. Postings (lang, term, source): occurrences and documents. Each lang keeps the
   terms found in ``min_docs`` of its documents.
3. Shares: p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in integers.
4. Sparse pair evaluation. Of a pair of sources (s, r) with shares b_s, b_r of a term that they lack,
   sum |p_s - p_r| over all V terms = V |b_s - b_r| + sum over s's terms (|p_s - b_r| - |b_s - b_r|) + the same for r's
   + sum over common terms (|p_s - p_r| - |p_s - b_r| - |b_s - p_r| + |b_s - b_r|). Terms that neither has are never touched.
   Sources are cut into blocks and terms into shards; a task holds one pair of blocks and one shard, of bounded
   size, and emits one number per pair of sources.
5. Ranks: pairs by a window over a source's partners (one row each, as many as
   the result has), terms by Spark's group limit, which keeps the first 50 before the shuffle.

Defined results: null text, lang and source count as empty; texts without terms still make their group
occur; a lang that keeps no term has value 0 (q is null) for every pair and no term rows; ties in value go to the smaller item
in UTF-8 order; repeated rows are documents of their own; very long texts are one
document like any other; an empty table gives an empty result; extra columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lendwise.llm.common import looked_up, released, small_enough, written

MIN_DOCS, TOP, ONE, ADDED = 30, 50, 1_000_000_000, 5
BLOCK, SHARD_ROWS, FLUSH = 256, 500_000, 1 << 18
#: Bits of the bitmap of copied texts: 16 per copied hash, within these (at most 16 MB).
LEAST_BITS, MOST_BITS = 20, 27
#: Bytes that are no part of a term become spaces, A-Z lose their case.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def copied_bitmap(rows: DataFrame) -> np.ndarray:
    """Bits of the cells (hash modulo the number of bits) that hold a hash seen twice or more."""
    copied = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "copied")
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * copied.count()).bit_length()))
    cell = F.pmod("h", F.lit(1 << bits))
    parts = copied.groupBy(F.shiftright(cell, 15).alias("part")).agg(F.bitmap_construct_agg(cell.bitwiseAND(F.lit(32767))).alias("bits"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.collect():  # at most 4,096 parts of 4 kB
        bitmap[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bitmap


class Tally:
    """Occurrences and documents per (lang, source, term), given out when many are held."""

    def __init__(self):
        self.held, self.size = {}, 0

    def add(self, lang: str, source: str, counts: Counter, copies: int) -> None:
        seen, docs = self.held.setdefault((lang, source), (Counter(), Counter()))
        before = len(seen)
        if copies == 1:
            seen.update(counts)
            docs.update(counts.keys())
        else:
            for t, c in counts.items():
                seen[t] += c * copies
                docs[t] += copies
        self.size += len(seen) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, docs) in self.held.items():
            n = len(seen)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array([source] * n), pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64()),
                     pa.array([docs[t] for t in seen], pa.int64()), pa.nulls(n, pa.string())], NAMES)
        self.held, self.size = {}, 0


NAMES = ["lang", "source", "term", "count", "docs", "text"]
POSTINGS = "lang string, source string, term string, count long, docs long, text string"


def tokenize_singles(bitmap: np.ndarray):
    """Rows (lang, source, text, h): postings of the texts that occur once; the others pass through as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, bits = Tally(), np.uint64(len(bitmap) * 8 - 1)
        for b in batches:
            cell = b.column(3).to_numpy().view(np.uint64) & bits
            again = (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1
            lang, source, text = (b.column(k) for k in range(3))
            for i in np.flatnonzero(again == 0):
                tally.add(lang[i].as_py(), source[i].as_py(), Counter(terms(text[i].as_py())), 1)
                if tally.size > FLUSH:
                    yield from tally.rows()
            at = pa.array(np.flatnonzero(again))
            none = [pa.nulls(len(at), t) for t in (pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), *none, text.take(at).cast(pa.string())], NAMES)
        yield from tally.rows()

    return run


def tokenize_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text, sources: array of source and number)."""
    tally = Tally()
    for b in batches:
        for lang, text, sources in zip(*(b.column(k) for k in range(3)), strict=True):
            counts = Counter(terms(text.as_py()))
            for s in sources.as_py():
                tally.add(lang.as_py(), s["source"], counts, s["n"])
                if tally.size > FLUSH:
                    yield from tally.rows()
    yield from tally.rows()


def postings(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, term, source, count, docs) of every term and (lang, source) of every occurring group."""
    known = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    hashed = known.withColumn("h", F.xxhash64("lang", "text"))
    bitmap = copied_bitmap(hashed.select("h"))
    groups = written(known.select("lang", "source").distinct(), "groups")
    first = written(hashed.select("lang", "source", F.col("text").cast("binary").alias("text"), "h").mapInArrow(released(tokenize_singles(bitmap)), POSTINGS), "singles")
    copies = first.filter("term is null").groupBy("lang", "text", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("lang", "text").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    second = copies.select("lang", F.col("text").cast("binary").alias("text"), "sources").mapInArrow(released(tokenize_copies), POSTINGS)
    both = first.filter("term is not null").unionByName(second)
    return both.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), groups


def share(count: str, n: str, v: str):
    """1 + floor(10^9 (count + 5) / (N + 5 V)); null where the lang keeps no term."""
    over = f"CAST({n} AS DECIMAL(20,0)) + {ADDED} * CAST({v} AS DECIMAL(18,0))"
    return F.expr(f"CASE WHEN {v} > 0 THEN 1 + ({ONE} * (CAST({count} AS DECIMAL(20,0)) + {ADDED})) div ({over}) END").cast("long")


def kept_terms(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(shares, groups). shares: lang, source, at (number of the source within the lang), term, p, q. groups: lang,
    source, at, v (kept terms of the lang), b (the share of a term that the source lacks), blocks (of the lang's sources)."""
    found, groups = postings(docs)
    found = written(found, "postings")
    whole = found.groupBy("lang", "term").agg(F.sum("count").alias("whole"), F.sum("docs").alias("df"), F.count(F.lit(1)).alias("sources"))
    whole = written(whole.filter(F.col("df") >= min_docs).drop("df"), "kept_terms")
    counted = written(looked_up(found.drop("docs"), whole, ["lang", "term"], "sources").drop("sources"), "counted")
    langs = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("whole").alias("lang_n"))
    sizes = counted.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("held"))
    w = Window.partitionBy("lang").orderBy("source")
    groups = groups.withColumn("at", F.row_number().over(w) - 1)  # one row per source of the lang
    blocks = groups.groupBy("lang").agg((F.floor(F.max("at") / BLOCK) + 1).cast("int").alias("blocks"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
    groups = groups.select("lang", "source", "at", zero("n"), zero("held"), zero("v"), zero("lang_n"), "blocks")
    groups = written(groups.withColumn("b", share("0", "n", "v")), "group_sizes")
    of = groups.filter("held > 0").select("lang", "source", "at", "n", "held", "v", "lang_n", "blocks")
    shares = looked_up(counted, of, ["lang", "source"], "held").select(
        "lang", "source", "at", "blocks", "term", share("count", "n", "v").alias("p"), share("whole", "lang_n", "v").alias("q"))
    return written(shares, "shares"), groups


def pair_sums(table: pa.Table) -> pa.Table:
    """One (lang, low, high, shard): the part of every pair's sum that the shard's terms make."""
    code = table["term"].combine_chunks().dictionary_encode().indices
    header = np.asarray(pc.is_null(table["term"]))
    at, p = table["at"].to_numpy(), table["p"].to_numpy(zero_copy_only=False)
    v = table["v"].to_numpy(zero_copy_only=False)
    known, order = np.unique(at[header], return_index=True)
    b, m = p[header][order].astype(np.int64), len(known)
    low, high, shard = (table[c][0].as_py() for c in ("low", "high", "shard"))
    s = np.searchsorted(known, at[~header])
    p, code = p[~header].astype(np.int64), code.to_numpy(zero_copy_only=False)[~header].astype(np.int64)
    gap = np.abs(b[:, None] - b[None, :])
    total = int(v[header].max(initial=0)) * gap if shard == 0 else np.zeros((m, m), np.int64)
    one = np.zeros((m, m), np.int64)  # of the terms of s alone
    (us, up), n = (lambda u, c: (u.T, c))(*np.unique(np.stack([s, p], axis=1), axis=0, return_counts=True)) if len(s) else ((s, p), s)
    for k in range(0, len(us), 4096):
        i, x, w = us[k:k + 4096], up[k:k + 4096], n[k:k + 4096]
        np.add.at(one, i, w[:, None] * (np.abs(x[:, None] - b[None, :]) - gap[i]))
    total = total + one + one.T
    order = np.lexsort((s, code))
    s, p, code = s[order], p[order], code[order]
    start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(code)))
    for c in np.unique(size[size > 1]):  # terms that c of the sources have
        rows, step = start[size == c], max(1, (1 << 20) // (c * c))
        for k in range(0, len(rows), step):
            cut = rows[k:k + step, None] + np.arange(c)[None, :]
            i, x = s[cut], p[cut]
            lack = b[i]
            pair = (np.abs(x[:, :, None] - x[:, None, :]) - np.abs(x[:, :, None] - lack[:, None, :])
                    - np.abs(lack[:, :, None] - x[:, None, :]) + np.abs(lack[:, :, None] - lack[:, None, :]))
            np.add.at(total, (i[:, :, None], i[:, None, :]), pair)
    i, j = np.nonzero((known[:, None] // BLOCK == low) & (known[None, :] // BLOCK == high) & (known[:, None] < known[None, :]))
    return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(i), pa.string()), "a": known[i].astype(np.int32), "b": known[j].astype(np.int32), "part": total[i, j]})


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every pair a < b of numbered sources."""
    shards = max(1, -(-shares.count() // SHARD_ROWS))
    block = F.floor(F.col("at") / BLOCK).cast("int")
    beside = lambda rows: rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "*", F.least(block, "other").alias("low"), F.greatest(block, "other").alias("high"))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard")
    columns = ["lang", "low", "high", "shard", "at", "term", "p", "v"]
    body = beside(shares).select("lang", "low", "high", shard, "at", "term", "p", F.lit(0).cast("long").alias("v"))
    heads = beside(groups).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    heads = heads.select("lang", "low", "high", "shard", "at", F.lit(None).cast("string").alias("term"), F.coalesce("b", F.lit(0)).alias("p"), "v")
    parts = body.select(columns).unionByName(heads.select(columns)).groupBy("lang", "low", "high", "shard").applyInArrow(
        pair_sums, "lang string, a int, b int, part long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the lang by the summed
    difference of shares, part ``term`` the ``top`` terms that the source has a greater share of than its lang."""
    shares, groups = kept_terms(docs, min_docs)
    pairs = written(pair_values(shares, groups), "pairs")
    names = groups.select("lang", "at", "source")
    names = F.broadcast(names) if small_enough(groups, "lang", "source") else names
    both = pairs.select("lang", "a", "b", "value").union(pairs.select("lang", "b", "a", "value"))
    both = both.join(names.withColumnRenamed("at", "a"), ["lang", "a"]).join(names.select("lang", F.col("at").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    over = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked = both.withColumn("rank", F.row_number().over(w)).withColumn("part", F.lit("pair")).select(columns)
    best = over.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).withColumn("part", F.lit("term")).select(columns)
    return ranked.unionByName(best)
