"""Language-model scoring with Brown class-based bigrams.

Tokens: words with A-Z lowered, then one end per document; the model learns from
documents whose crc32(id as text) mod ``folds`` is not ``held``.

1. ``staged``: tasks cut their documents into blocks of bounded text, number the
   words of a block, and write documents as word numbers and the block's words with
   their training counts. Text is read once; no dictionary is ever broadcast or
   held whole.
2. Counts of a word meet by word and go back to the blocks it occurs in, so each block
   learns the corpus count of each of its words (``encoded``).
3. Words seen at least ``least`` times are clustered, however large the corpus, and numbered
   by rank in a table; rarer words form classes by the binary order of their count, and
   words seen once share a class with unseen words. All these are model
   symbols of 32 bits. ``frequent``, where given, also asks for 1/``frequent`` of all tokens.
4. Exchange clustering over the counted symbol bigrams: in each round half of the clustered words
   (the two halves take turns) may move, each to the class that raises the class-bigram likelihood
   most given the other words' classes. It ends when a turn of both halves brings no rise
   (or after ``rounds``, where given); the best round's classes stay. There are 64 classes, and from
   32,768 words on twice the cube root of their number. Words, contexts and counts are tables: bigrams are
   dealt by word once, before the rounds, so that a round decides on a word where its bigrams lie and shuffles only the class
   contexts of the ``HOT`` most frequent words, whose bigrams are spread. Driver and tasks hold the class of each
   clustered word (2 bytes) and the class bigrams.
5. P(w | v) = P(class w | class v) * P(w | class w). Transitions are
   smoothed with the class frequencies; in the class of words seen once, ``unseen`` of
   the mass is the unknown word's. It sums to one over known words, the end and one unknown word.

Defined results: null and empty texts are the end alone; very long texts are learnt and scored whole, within one block; a null id has remainder
0; repeated rows count repeatedly; without training tokens every word
is unknown; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendwise.llm.common import discard_written, numbered, released, small_enough, written
from lendwise.llm.ngrams import mixed

FOLDS, HELD = 7, 2
LEAST, CLASSES, UNSEEN, SMOOTH = 5, 64, 0.5, 10.0
BLOCK_BYTES, SPAN = 16 << 20, 2 << 20
#: The end's name among words (no word holds a line break); symbols of rarer and unknown
#: words, below zero: they index the end of an array over all symbols.
END = b"\n"
BAND, ONCE, UNKNOWN, OTHERS = -100, -2, -1, 100
#: Counts up to this have their gains in a table.
FEW = 8
#: Words up to this rank have their bigrams in SPREAD parts; a part has about 2^PART_BITS tokens.
HOT, SPREAD, PART_BITS = 64, 16, 18


def held_out(doc_id, folds: int = FOLDS, held: int = HELD) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == held


def numbered_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word numbers of all texts, each text ending with the end's number 0; end of each text among them; the names).
    Words stand beside their texts only for SPAN bytes of text at a time."""
    found, counts = [pa.array([END.decode()], pa.large_string()).dictionary_encode()], []
    for part in spans(texts):
        lowered = pc.ascii_lower(part.cast(pa.large_string()).fill_null(""))  # A-Z only
        lists = pc.ascii_split_whitespace(lowered)
        words, doc = lists.flatten(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        some = pc.greater(pc.binary_length(words), 0)  # white space at the ends of a text leaves empty words
        found.append(words.filter(some).dictionary_encode())
        counts.append(np.bincount(doc[some.to_numpy(zero_copy_only=False)], minlength=len(lists)))
    found = pa.chunked_array(found).unify_dictionaries()  # in the order in which words come first
    ends = np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]) + 1)
    seq, at = np.zeros(ends[-1] if len(ends) else 0, np.uint32), 0
    for words, n in zip(found.chunks[1:], counts, strict=True):
        own = seq[at:at + len(words) + len(n)]
        own[np.arange(len(words)) + np.repeat(np.arange(len(n)), n)] = words.indices.to_numpy()
        at += len(own)
    return seq, ends, found.chunk(0).dictionary


def spans(texts: pa.ChunkedArray):
    """The texts in order, some at a time: about SPAN bytes, or one longer text."""
    for chunk in texts.chunks:
        ends, at = np.cumsum(pc.binary_length(chunk).fill_null(0).to_numpy().astype(np.int64)), 0
        while at < len(chunk):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SPAN, "right")))
            yield chunk.take(pa.array(np.arange(at, end)))  # not a slice: Arrow's string functions take whole buffers
            at = end


def counted(texts, size: int) -> np.ndarray:
    """How often each number below ``size`` occurs in texts of numbers."""
    c, waiting, held = np.zeros(size, np.int64), [], 0
    for seq in texts:
        waiting.append(seq)
        held += len(seq)
        if held >= max(size, 1 << 19):
            c += np.bincount(np.concatenate(waiting), minlength=size)
            waiting, held = [], 0
    return c + np.bincount(np.concatenate([np.zeros(0, np.uint32), *waiting]), minlength=size)


def staged(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int, block_bytes: int) -> DataFrame:
    """Written rows, of a word (block, number, word, n) or of a document
    (block, id, held_out, numbers as unsigned 32-bit, packed)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        task, blocks, waiting, size = TaskContext.get().partitionId() << 24, 0, [], 0
        for b in batches:
            ends = np.cumsum(pc.binary_length(b.column(1)).fill_null(0).to_numpy().astype(np.int64))
            at = 0
            while at < b.num_rows:
                before = ends[at - 1] if at else 0
                end = min(b.num_rows, int(np.searchsorted(ends, before + block_bytes - size)) + 1)
                waiting.append(b.take(pa.array(np.arange(at, end))))  # not a slice, which would hold all of the batch
                size, at = size + int(ends[end - 1] - before), end
                if size >= block_bytes:
                    yield from block(task + blocks, waiting)
                    waiting, size, blocks = [], 0, blocks + 1
        if waiting:
            yield from block(task + blocks, waiting)

    def block(number, waiting):
        ids = pa.concat_arrays([b.column(0) for b in waiting])
        seq, ends, names = numbered_words(pa.chunked_array([b.column(1) for b in waiting]))
        waiting.clear()  # the texts are not needed any more
        out = np.array([held_out(x.as_py(), folds, held) for x in ids], bool)
        starts = np.append(0, ends[:-1])
        n = counted((seq[starts[r]:ends[r]] for r in np.flatnonzero(~out)), len(names))
        for at in range(0, len(out), 1 << 12):
            rows = range(at, min(at + (1 << 12), len(out)))
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.string()), pa.nulls(m, pa.int64()), ids.slice(at, m),
                 pa.array(out[at:at + m]), pa.array([zlib.compress(seq[starts[r]:ends[r]].tobytes(), 1) for r in rows], pa.binary())], names=columns)
        for at in range(0, len(names), 50_000):
            part = names.take(pa.array(np.arange(at, min(at + 50_000, len(names)))))
            m = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number)), pa.array(np.arange(at, at + m, dtype=np.int32)), part.cast(pa.string()), pa.array(n[at:at + m], pa.int64()),
                 pa.nulls(m, ids.type), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary())], names=columns)

    columns = ["block", "number", "word", "n", "id", "held_out", "numbers"]
    return written(rows.mapInArrow(released(run), f"block long, number int, word string, n long, id {kind}, held_out boolean, numbers binary"), "staged")


def symbol(c: np.ndarray) -> np.ndarray:
    """Symbols of words that are not frequent, by their training counts."""
    band = BAND + np.floor(np.log2(np.maximum(c, 1))).astype(np.int64)
    return np.where(c == 0, UNKNOWN, np.where(c == 1, ONCE, band))


def encoded(rows: DataFrame, frequent: int | None = None, least: int = LEAST) -> tuple[DataFrame, dict]:
    """(written documents as symbols with their count sums; totals)."""
    words = rows.filter("number is not null").select("block", "number", "word", "n")
    by = Window.partitionBy("word")
    words = words.select("block", "number", "word", "n", F.sum("n").over(by).alias("c"), F.min("block").over(by).alias("first"))
    words = written(words, "words")
    once = words.filter((F.col("block") == F.col("first")) & (F.col("c") > 0))
    totals = once.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct"),
                      F.count_if(F.col("c") == 1).alias("once")).first().asDict()
    is_end, clustered = F.col("word") == END.decode(), F.col("c") >= least
    if frequent is not None:
        clustered = clustered & (F.col("c") * frequent >= totals["tokens"])
    ids = numbered(once.filter(clustered & ~is_end).select("word", "c"), [F.desc("c"), F.asc("word")], "ranked") \
        .select("word", F.col("rank").cast("int").alias("symbol"))
    n_words = ids.count()
    side = F.broadcast(ids) if small_enough(ids, "word") else ids
    # A rarer word that no other block has needs no answer: its corpus count is its count here.
    columns = ["block", "number", "c", "symbol"]
    answers = words.filter(clustered & ~is_end).join(side, "word").select(columns).unionByName(
        words.filter(is_end | ~clustered & (F.col("c") != F.col("n"))).withColumn("symbol", F.when(is_end, 0)).select(columns))
    documents = rows.filter("number is null").select("block", "id", "held_out", "numbers")

    def encode(docs: pa.Table, known: pa.Table) -> pa.Table:
        texts = [np.frombuffer(zlib.decompress(x), np.uint32) for x in docs.column("numbers").to_pylist()]
        learnt = (seq for seq, out in zip(texts, docs.column("held_out").to_pylist(), strict=True) if not out)
        c = counted(learnt, 1 + max(int(t.max()) for t in texts))
        n = known.column("number").to_numpy()
        c[n] = known.column("c").to_numpy()
        own = symbol(c)
        fixed = known.column("symbol").fill_null(-1).to_numpy()
        own[n] = np.where(fixed >= 0, fixed, symbol(c[n]))
        log_c, log_c1 = np.log10(np.maximum(c, 1)), np.log10(c + 1.0)
        made = {k: [] for k in ("n_tokens", "n_known", "log_c", "log_c1", "symbols")}
        for seq in texts:
            for k, v in zip(made, (len(seq), int((c[seq] > 0).sum()), float(log_c[seq].sum()), float(log_c1[seq].sum()),
                                  zlib.compress(own[seq].astype("<i4").tobytes(), 1)), strict=True):
                made[k].append(v)
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        columns = [pa.array(v, t) for v, t in zip(made.values(), types, strict=True)]
        return pa.table([docs.column("id"), docs.column("held_out"), *columns], names=["id", "held_out", *made])

    schema = f"id {dict(rows.dtypes)['id']}, held_out boolean, n_tokens long, n_known long, log_c double, log_c1 double, symbols binary"
    made = written(documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(encode, schema), "encoded")
    discard_written(words)
    return made, totals | {"frequent": n_words + 1}


def parts_of(word: np.ndarray, other: np.ndarray, parts: int) -> np.ndarray:
    """The part that has a bigram of a word: one for all of a word, but of the most frequent words, the end and
    the rarer words' symbols SPREAD ones, so that no part grows with one of them."""
    return (mixed((word * SPREAD + np.where(word <= HOT, other % SPREAD, 0)).view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def turned(pair: np.ndarray, before: bool) -> np.ndarray:
    """Packed bigrams (first << 32 | second), or where ``before`` with the second word first."""
    return pair.astype(np.int32).astype(np.int64) << 32 | pair >> 32 & 0xFFFFFFFF if before else pair


def packed(n: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0)))).tobytes()


def unpacked(n: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(n, f"<u{len(n) // rows}").astype(np.int64) if rows else np.zeros(0, np.int64)


def dealt(pair: np.ndarray, parts: int):
    """Batches (part, before, pairs, n) of packed bigrams, which this sorts and counts in their place: memory grows
    with no more than a few numbers for each."""
    pair.sort()
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])).astype(np.uint32)
    n = np.diff(starts, append=np.uint32(len(pair)))
    pair[:len(starts)] = pair[starts]
    pair = pair[:len(starts)]
    for before in (False, True):
        part = np.empty(len(pair), np.uint16 if parts < 1 << 16 else np.int32)
        for at in range(0, len(pair), 1 << 17):
            some = turned(pair[at:at + (1 << 17)], before)
            word, other = some >> 32, some.astype(np.int32).astype(np.int64)
            part[at:at + (1 << 17)] = np.where((word <= 0) & before, parts, parts_of(word, other, parts))  # no part has these
        order = np.argsort(part, kind="stable")
        part = part[order]
        order = order[:np.searchsorted(part, parts)]
        part = part[:len(order)]
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(part))
        step = max(1, (len(starts) << 18) // max(1, len(part)))
        for at in range(0, len(starts), step):
            a, b = starts[at:at + step], ends[at:at + step]
            own = order[a[0]:b[-1]]
            pairs, m, rows = turned(pair[own], before), n[own], list(zip(a - a[0], b - a[0], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[a].astype(np.int32)), pa.array([before] * len(rows)), pa.array([pairs[i:j].tobytes() for i, j in rows], pa.binary()),
                 pa.array([packed(m[i:j]) for i, j in rows], pa.binary())], ["part", "before", "pairs", "n"])


def bigrams(documents: DataFrame) -> DataFrame:
    """Written counts of symbol bigrams of training documents; a document begins after an end. They are
    dealt by word, once by the word that stands first and once by the clustered word that stands second: each row
    (half, hot, and of both sides word and other as packed 32-bit symbols, n) has all that some words occur with, or
    where hot a share of it. half is the turn in which these words may move, -1 if they never do."""
    tokens = documents.filter("not held_out").agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    parts = max(1, tokens >> PART_BITS)

    def run(batches):
        waiting, held = np.empty(1 << 22, np.int64), 0
        for b in batches:
            for symbols in b.column(0):
                seq, at = np.frombuffer(zlib.decompress(symbols.as_py()), "<i4").astype(np.int64), 0
                seq = np.append(0, seq[:-1]) << 32 | seq & 0xFFFFFFFF
                while at < len(seq):
                    some = seq[at:at + len(waiting) - held]
                    waiting[held:held + len(some)] = some
                    held, at = held + len(some), at + len(some)
                    if held == len(waiting):
                        yield from dealt(waiting, parts)
                        held = 0
        if held:
            yield from dealt(waiting[:held], parts)

    def gathered(table: pa.Table) -> pa.Table:
        sides, before = [], table.column("before").to_numpy()
        for second in (False, True):
            rows = table.filter(pa.array(before == second))
            pair = [np.frombuffer(x, np.int64) for x in rows.column("pairs").to_pylist()]
            n = [unpacked(x, len(p)) for x, p in zip(rows.column("n").to_pylist(), pair, strict=True)]
            empty = np.zeros(0, np.int64)
            pair, n = merged(np.concatenate([empty, *pair]), np.concatenate([empty, *n]))
            word, other = pair >> 32, pair.astype(np.int32)
            sides.append((word, other, n, np.where(word > 0, 1 - own_turn(word, 0), -1), word <= HOT))
        made = {"half": [], "hot": []} | {f"{c}_{x}": [] for x in "ab" for c in ("word", "other", "n")}
        for half, hot in ((0, False), (1, False), (0, True), (1, True), (-1, True)):
            own = [np.flatnonzero((s[3] == half) & (s[4] == hot)) for s in sides]
            if sum(map(len, own)):
                made["half"].append(half)
                made["hot"].append(hot)
                for x, rows, (word, other, n, *_) in zip("ab", own, sides, strict=True):
                    made[f"word_{x}"].append(word[rows].astype(np.int32).tobytes())
                    made[f"other_{x}"].append(other[rows].tobytes())
                    made[f"n_{x}"].append(packed(n[rows]))
        return pa.table([pa.array(made.pop("half"), pa.int32()), pa.array(made.pop("hot"), pa.bool_()), *[pa.array(v, pa.binary()) for v in made.values()]],
                        names=["half", "hot", *made])

    rows = documents.filter("not held_out").select("symbols").mapInArrow(released(run), "part int, before boolean, pairs binary, n binary")
    return written(rows.groupBy("part").applyInArrow(gathered, "half int, hot boolean, word_a binary, other_a binary, n_a binary, "
                                                     "word_b binary, other_b binary, n_b binary"), "bigrams")


def xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0.0)
    return x * np.log(np.maximum(x, 1.0))


def first_classes(frequent: int, classes: int) -> np.ndarray:
    """Class of each symbol: the end 0, frequent words 1..classes by rank in
    turn, then a class per count order, and one for words seen once and unknown ones."""
    out = np.zeros(frequent + OTHERS, np.int16)
    out[1:frequent] = 1 + np.arange(frequent - 1) % classes
    out[BAND:BAND + 64] = 1 + classes + np.arange(64)
    out[ONCE] = out[UNKNOWN] = 1 + classes
    return out


def side(word: pa.Scalar, other: pa.Scalar, n: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, other, count) of one side of a row of ``bigrams``."""
    word, other = (np.frombuffer(x.as_buffer(), "<i4") for x in (word, other))
    return word.astype(np.int64), other, unpacked(n.as_py(), len(word))


def merged(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, sum of n of each). Keys are sorted with their places as low bits."""
    if not len(key):
        return key, n
    bits, least = max(len(key) - 1, 1).bit_length(), key.min()
    if int(key.max() - least) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        key = key[order]
    else:
        both = np.sort((key - least) << bits | np.arange(len(key)))
        key, order = (both >> bits) + least, both & ((1 << bits) - 1)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[starts], np.add.reduceat(n[order], starts)


def own_turn(words: np.ndarray, turn: int) -> np.ndarray:
    """Which words may move: each in every second round."""
    return (words * 2654435761 >> 7) + turn & 1 == 0


def class_counts(pairs: DataFrame, classes: np.ndarray, top: int, frequent: int, turn: int = 0) -> tuple[np.ndarray, DataFrame]:
    """(class bigram counts, the rows of the words that may move)."""
    def total(batches):
        matrix = np.zeros(top * top)
        for b in batches:
            for row in zip(*b.columns, strict=True):
                v, w, n = side(*row)
                matrix += np.bincount(classes[v].astype(np.int32) * top + classes[w], n, minlength=top * top)
        k = np.flatnonzero(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(matrix[k].astype(np.int64))], ["k", "n"])

    matrix = np.zeros(top * top)
    found = pairs.select("word_a", "other_a", "n_a").mapInArrow(released(total), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    matrix[found.column("k").to_numpy()] = found.column("n").to_numpy()  # at most top * top numbers
    return matrix.reshape(top, top), pairs.filter(F.col("half") == turn % 2)


def likelihood(matrix: np.ndarray) -> float:
    return float(xlogx(matrix).sum() - xlogx(matrix.sum(axis=1)).sum() - xlogx(matrix.sum(axis=0)).sum())


def best_classes(words: np.ndarray, k: np.ndarray, n: np.ndarray, classes: np.ndarray, matrix: np.ndarray,
                 n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, the class of the greatest likelihood for each, the others given), from
    contexts (word, k, n) sorted by word and k, without repeats. Only cells that a word occurs in are touched."""
    top = len(matrix)
    cells = np.concatenate([matrix[1:n_classes + 1].T, matrix[:, 1:n_classes + 1]])  # by k: cells of each class
    table = xlogx(cells)
    # Most contexts are of one or a few occurrences: what so many add to a cell is computed once per cell.
    few = np.concatenate([xlogx(cells + m) - table for m in range(1, FEW + 1)]) if len(words) else None
    starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    ends, best = np.append(starts[1:], len(words)), []
    sums = [matrix.sum(axis=1)[1:n_classes + 1], matrix.sum(axis=0)[1:n_classes + 1]]
    a = 0
    while a < len(starts):  # some words at a time, so that the work table (2 MB) stays in the cache
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + (1 << 18) // n_classes, "right")))
        rows = slice(starts[a], ends[b - 1])
        first, kk, nn = starts[a:b] - starts[a], k[rows], n[rows].astype(float)
        word = np.repeat(np.arange(b - a), ends[a:b] - starts[a:b])
        own, at, before = classes[words[starts[a:b]]].astype(np.int64), np.arange(len(kk)), kk >= top
        many = np.flatnonzero(nn > FEW)
        added = few.take((np.minimum(n[rows], FEW) - 1) * len(cells) + kk, axis=0)
        added[many] = xlogx(cells[kk[many]] + nn[many, None]) - table[kk[many]]
        other = kk - top * before
        hit = np.full((2, b - a), -1)
        mine = other == own[word]
        hit[before[mine].astype(int), word[mine]] = at[mine]
        facing = hit[1 - before.astype(int), word]
        cross = (facing >= 0) & (other >= 1) & (other <= n_classes)
        # Cells that hold the word's own counts, which are taken out: the word's class in each row, and where it stands on the other side.
        spot, taken = merged(np.concatenate([at * n_classes + own[word] - 1, facing[cross] * n_classes + other[cross] - 1]),
                             np.concatenate([nn, nn[cross]]))
        row, column = spot // n_classes, spot % n_classes
        base = np.maximum(cells[kk[row], column] - taken, 0)
        added[row, column] = xlogx(base + nn[row]) - xlogx(base)
        gain = np.add.reduceat(added, first, axis=0)
        # A class both before and after the word: its own cell grows by both counts at once.
        mid = (other >= 1) & (other <= n_classes)
        right, left = np.flatnonzero(mid & ~before), np.flatnonzero(mid & before)
        _, r, l = np.intersect1d((word * top + other)[right], (word * top + other)[left], assume_unique=True, return_indices=True)
        right, left = right[r], left[l]
        cell = cells[kk[right], other[right] - 1]
        where = np.searchsorted(spot, right * n_classes + other[right] - 1)
        held = spot[np.minimum(where, len(spot) - 1)] == right * n_classes + other[right] - 1
        cell[held] = base[where[held]]
        both = xlogx(cell + nn[right] + nn[left]) - xlogx(cell + nn[right]) - xlogx(cell + nn[left]) + xlogx(cell)
        gain[word[right], other[right] - 1] += both
        words_here = np.arange(b - a)
        for place in (0, 1):  # many words have the same number of tokens there
            weight = np.add.reduceat(nn * (before == place), first)
            distinct, which = np.unique(weight, return_inverse=True)
            whole = xlogx(sums[place])
            gain_of = xlogx(sums[place] + distinct[:, None]) - whole
            mine = own - 1
            total = sums[place][mine]
            kept = gain[words_here, mine] - (xlogx(total - weight + weight) - xlogx(total - weight))
            gain -= gain_of.take(which, axis=0)
            gain[words_here, mine] = kept
        best.append(1 + np.argmax(gain, axis=1))
        a = b
    return words[starts], np.concatenate([np.zeros(0, np.int64), *best])


def moves(pairs: DataFrame, classes: np.ndarray, matrix: np.ndarray, n_classes: int) -> np.ndarray:
    """Classes after one exchange round of the words of ``pairs``; collects one narrow row per word that moves.
    Words whose bigrams are all in one row are decided there; only the contexts of the others (hot) are shuffled."""
    top = len(matrix)

    def contexts(row):
        """(key, n) in order: what stands after (k < top) and before the words; key = word * 2 * top + k"""
        (v, w, n), (word, before, m) = side(*row[:3]), side(*row[3:])
        return merged(np.concatenate([v * (2 * top) + classes[w], word * (2 * top) + top + classes[before]]), np.concatenate([n, m]))

    def moved(key, n):
        words, best = best_classes(key // (2 * top), key % (2 * top), n, classes, matrix, n_classes)
        new = best != classes[words]
        return [pa.array(words[new], pa.int64()), pa.array(best[new], pa.int64())]

    def decide(batches):
        for b in batches:
            for row in zip(*b.columns, strict=True):
                yield pa.RecordBatch.from_arrays(moved(*contexts(row)), ["word", "class"])

    def around(batches):
        for b in batches:
            for row in zip(*b.columns, strict=True):
                key, n = contexts(row)
                yield pa.RecordBatch.from_arrays([pa.array(key // (2 * top)), pa.array(key), pa.array(n)], ["word", "key", "n"])

    def decide_hot(table: pa.Table) -> pa.Table:
        return pa.table(moved(*merged(table.column("key").to_numpy(), table.column("n").to_numpy())), names=["word", "class"])

    sides, schema = [f"{c}_{x}" for x in "ab" for c in ("word", "other", "n")], "word long, class long"
    hot = pairs.filter("hot").select(sides).mapInArrow(released(around), "word long, key long, n long")
    found = pairs.filter("not hot").select(sides).mapInArrow(released(decide), schema) \
        .unionByName(hot.groupBy("word").applyInArrow(decide_hot, schema)).toArrow()
    out = classes.copy()
    out[found.column("word").to_numpy()] = found.column("class").to_numpy()
    return out


def class_number(frequent: int) -> int:
    return max(CLASSES, int(np.ceil(2 * np.cbrt(frequent - 1) - 1e-9)))


def exchanged(pairs: DataFrame, frequent: int, n_classes: int, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(class of each symbol, class bigram counts) of the best of the rounds."""
    top = 1 + n_classes + 64
    classes, best, turn, without = first_classes(frequent, n_classes), None, 0, 0
    while True:
        matrix, moving = class_counts(pairs, classes, top, frequent, turn)
        value = likelihood(matrix)
        without = 0 if best is None or value > best[0] else without + 1
        if not without:
            best = (value, classes, matrix)
        if turn == rounds or without == 2 or frequent < 2:
            return best[1], best[2]
        classes = moves(moving, classes, matrix, n_classes)
        turn += 1


def probabilities(matrix: np.ndarray, classes: np.ndarray, once: int) -> tuple[np.ndarray, np.ndarray]:
    """(log10 transitions between classes, log10 emission of each symbol without its
    word's own count)."""
    size = matrix.sum(axis=0)
    overall = (size + 1) / (size.sum() + len(size))
    transition = (matrix + SMOOTH * overall) / (matrix.sum(axis=1, keepdims=True) + SMOOTH)
    emission = -np.log10(np.maximum(size, 1))[classes]
    emission[ONCE] = np.log10((1 - UNSEEN) / max(once, 1))
    emission[UNKNOWN] = np.log10(UNSEEN) if once else 0.0
    return np.log10(transition), emission


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held: int = HELD, frequent: int | None = None,
          classes: int | None = None, rounds: int | None = None, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (log10), perplexity of the class model."""
    rows = staged(docs, id_col, text_col, folds, held, block_bytes)
    documents, totals = encoded(rows, frequent, least)
    discard_written(rows)
    pairs = bigrams(documents)
    class_of, matrix = exchanged(pairs, totals["frequent"], classes or class_number(totals["frequent"]), rounds)
    discard_written(pairs)
    # Emissions by class; those of words seen once and of unknown ones are the last two.
    transition, emission = probabilities(matrix, np.append(np.arange(len(matrix)), [0, 0]), totals["once"])

    def run(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for k, symbols in enumerate(b.column(6)):
                seq = np.frombuffer(zlib.decompress(symbols.as_py()), "<i4")
                own = class_of[seq]
                out[k] = transition[np.append(0, own[:-1]), own].sum() + emission[np.where((seq == ONCE) | (seq == UNKNOWN), seq, own)].sum()
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(out)], names=[*b.schema.names[:6], "log_class"])

    schema = f"id {dict(documents.dtypes)['id']}, held_out boolean, n_tokens long, n_known long, log_c double, log_c1 double, log_class double"
    n, v = totals["tokens"], totals["distinct"]
    scores = documents.mapInArrow(released(run), schema)
    total = F.col("log_class") + F.col("log_c")
    return scores.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         (F.col("log_c1") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
                         total.alias("score"), F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))
