"""SimHash near-dedup by anchor-point covering.

Fingerprints are 64 bits over hashed word shingles. Two that differ in at most
``distance`` bits agree up to ``distance // segments`` bits in at least one of the
segments they are cut into. In each segment the codewords of a perfect
code are anchors: every point lies within the covering radius R of one. A fingerprint is
replicated to every anchor within R + distance // segments, so both ends of a link meet
at the anchor nearest to one of them. Per anchor all members are compared on the full 64 bits.

Codes: binary Golay (23 bits, 4,096 anchors, R = 3) twice and Hamming (15
bits, 2,048 anchors, R = 1): 18 replicas per distinct fingerprint on average.

Only distinct fingerprints take part, so copies cost nothing. An anchor
emits a spanning forest of the links that it finds (fewer rows than members), never
all pairs, which keeps every connection. Components are found by rounds of joins.

Defined results: texts without words (null, empty) have fingerprint zero and
are linked like any other; a very long text is one fingerprint of all its shingles; repeated rows are linked; null ids never name a component unless
all its ids are null; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import WORD, forget_held, looked_up, new_names, released, written
from lendwise.llm.components import component_roots

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fixed values: (first bit, bits, generator polynomial, covering radius) of each segment's perfect code.
SEGMENTS = ((0, 23, 0b101011100011, 3), (23, 23, 0b101011100011, 3), (46, 15, 0b10011, 1))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits that are set in over half of the XXH64 hashes of the word shingles."""
    import xxhash

    words = re.findall(WORD.encode(), (text or "").encode().lower())  # bytes.lower() touches A-Z only
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    hash_of = xxhash.xxh64_intdigest
    if len(words) < shingle:
        spans = [(0, ends[-1])]
    else:
        spans = zip(starts, ends[shingle - 1:])
    hashes = np.array([hash_of(joined[a:b], seed) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def prints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Written slim rows: id, text_hash, fp (the fingerprint as a signed long)."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_held()
        for b in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["id", "text_hash", "fp"])

    return written(rows.mapInArrow(released(run), f"id {dict(rows.dtypes)['id']}, text_hash long, fp long"), "prints")


def code(segment: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(syndromes of low and high half points, starts, patterns, half): the error
    patterns within reach of an anchor, in order of their syndrome."""
    _, bits, generator, radius = SEGMENTS[segment]
    reach = radius + distance // len(SEGMENTS)
    degree = generator.bit_length() - 1
    rest = []
    for k in range(bits):  # x^k modulo the generator
        r = 1 << k
        while r.bit_length() > degree:
            r ^= generator << (r.bit_length() - degree - 1)
        rest.append(r)
    half = (bits + 1) // 2
    table = np.zeros((2, 1 << half), np.int64)
    for side in (0, 1):
        for k in range(half):
            if side * half + k < bits:
                table[side, 1 << k:2 << k] = table[side, :1 << k] ^ rest[side * half + k]
    patterns = np.array([sum(1 << k for k in c) for w in range(reach + 1) for c in itertools.combinations(range(bits), w)], np.int64)
    syndromes = table[0, patterns & ((1 << half) - 1)] ^ table[1, patterns >> half]
    order = np.argsort(syndromes, kind="stable")
    starts = np.searchsorted(syndromes[order], np.arange((1 << degree) + 1))
    return table, starts, patterns[order], half


def anchors(points: np.ndarray, segment: int, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row of the point, anchor key) for every anchor within reach of a point."""
    (first, bits, _, _), (table, starts, patterns, half) = SEGMENTS[segment], tables
    own = (points.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)
    s = table[0, own & ((1 << half) - 1)] ^ table[1, own >> half]
    n = starts[s + 1] - starts[s]
    row = np.repeat(np.arange(len(points)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + starts[s][row]
    return row, (segment << 32) | (own[row] ^ patterns[at])


def forest(members: np.ndarray, distance: int, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) links that connect what links within ``distance`` connect."""
    v = np.unique(members.view(np.uint64))
    step = max(1, block // max(1, len(v)))
    linked = [(np.bitwise_count(v[k:k + step, None] ^ v[None, :]) <= distance).sum(axis=1) > 1 for k in range(0, len(v), step)]
    left = v[np.concatenate(linked)] if linked else v
    nodes, roots = [], []
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            part, front = front[:64], front[64:]
            hit = (np.bitwise_count(part[:, None] ^ left[None, :]) <= distance).any(axis=0)
            nodes.append(left[hit])
            roots.append(np.full(hit.sum(), root, np.uint64))
            front, left = np.concatenate([front, left[hit]]), left[~hit]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *nodes]).view(np.int64), np.concatenate([empty, *roots]).view(np.int64)


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp): a subset of the
    links, of one spanning forest per anchor, with the same components."""
    def replicate(batches):
        codes = [code(k, distance) for k in range(len(SEGMENTS))]
        for b in batches:
            v = b.column(0).to_numpy()
            for k, tables in enumerate(codes):
                row, key = anchors(v, k, tables)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(v[row])], ["anchor", "fp"])

    def compare(batches):
        key, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(key, v):
            cuts = np.flatnonzero(np.diff(key)) + 1
            made = [forest(part, distance) for part in np.split(v, cuts) if len(part) > 1]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([m[i] for m in made])) for i in (0, 1)], ["a", "b"])

        for b in batches:  # rows come sorted by anchor; the last anchor of a batch may go on in the next
            key, waiting = np.concatenate([key, b.column(0).to_numpy()]), np.concatenate([waiting, b.column(1).to_numpy()])
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if done:
                yield from found(key[:done], waiting[:done])
                key, waiting = key[done:], waiting[done:]
        if len(key):
            yield from found(key, waiting)

    spread = points.select("fp").mapInArrow(released(replicate), "anchor long, fp long")
    return spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(released(compare), "a long, b long")


def groups(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Rows of ``near_groups`` with ``stay``: whether the row is the one of its component with the least
    (id, nulls last, text_hash), which its repeated rows are too."""
    rows = prints(docs, id_col, text_col, shingle)
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    points = written(rows.groupBy("fp").agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("n")), "points")
    roots = component_roots(links(points, distance))
    root = F.coalesce("b", "fp").alias("root")
    labelled = written(points.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "least", "n", root), "labels")
    # Few points share a root with others; only those need its least id.
    least = labelled.groupBy("root").agg(F.min("least").alias("least"))
    entries = written(labelled.drop("least").join(least, "root").select("fp", "n", "least"), "components")
    return looked_up(rows, entries, ["fp"], "n").select(
        F.col("id").alias(id_col), "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("stay"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, text_hash, fingerprint (16 hex digits),
    component_id (the least id of those reachable by links)."""
    return groups(docs, id_col, text_col, **options).drop("stay")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document
    with the least id (nulls last) stays, of several with that id the one with the least text hash, of repeated rows one."""
    key, of, text_hash = new_names(docs.columns, "key", "id", "hash")
    stay = groups(docs, id_col, text_col, **options).filter("stay")
    stay = stay.select(F.col(id_col).alias(of), F.col("text_hash").alias(text_hash)).distinct()
    rows = docs.withColumn(key, F.xxhash64(docs[text_col]))
    kept = rows.join(stay, rows[id_col].eqNullSafe(stay[of]) & (rows[key] == stay[text_hash]), "left_semi")
    return kept.dropDuplicates([id_col, key]).drop(key)
