"""Line dedup by an exact set-similarity join.

A line (of those with a word) is the set of its 5-word shingles, A-Z lowered;
a line of fewer words is one token. A line is removed if an earlier one, in order of (id, line number), has
a Jaccard similarity of at least ``similar``. All sets are of 64-bit hashes.

1. ``lines``: every line's key (128-bit hash of its words) and place, the line numbers of each
   document, and counts of shingles per hash cell. Equal lines form a class, and only a class's first line
   goes on, so copies never meet pairwise.
2. Order tokens by rarity: (count of the token's cell, hash). Any order shared by all lines
   gives the exact join; rare tokens first keep the posting lists short. Two
   similar lines share a token of their prefixes of size - ceil(similar * size) + 1 tokens.
3. Postings: prefix tokens meet by token. First each line is tried against the
   earliest line of the posting only (length and positional filter, then the exact Jaccard), which
   settles groups of near copies in one row per line. Lines not settled so are joined with all
   earlier lines of their postings. Both are behind length, positional and bitmap
   filters; tables that no later step reads are deleted. The join is an equi-join on the token, whose hot keys Spark splits.
4. Lines stay that are their class's first and whose class has no earlier match. They meet their
   document's line numbers, of which the others are removed.

Defined results: null and empty texts have no lines; very long texts are read whole, one span each; lines without a word
always stay; rows repeated with the same id and text get the same decision; null ids rank last; an
empty table gives an empty result; extra columns may have any name. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import discard_written, forget_held, new_names, released, written
from lendwise.llm.ngrams import SPACE, TokenHasher, buffer, mixed

SHINGLE, SIMILAR = 5, Fraction(4, 5)
CELL_BITS, FILTER_BITS = 16, 24
LAST = (1 << 63) - 1
#: Odd multipliers of the two hashes of a line's words.
LINE_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class LineHasher(TokenHasher):
    """Lines of a batch of texts as sets of shingle hashes, by numpy only."""

    def __init__(self, shingle: int = SHINGLE):
        super().__init__()
        self.kinds = np.ones(256, np.uint8)
        self.kinds[SPACE] = 0
        self.shingle = shingle
        self.line_powers = [(np.ones(1, np.uint64),) * 2 for _ in LINE_BASES]

    def lines(self, texts: pa.Array, chosen: Callable[[np.ndarray], np.ndarray] | None = None, span: int = 1 << 18) -> Iterator[tuple]:
        """Yields (text row, line number, h1, h2, first token of each line, tokens) of some texts at a time.
        ``chosen`` maps the h1 of lines to a mask of those whose tokens are asked for, else all are."""
        data, offsets = buffer(texts)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + span, "right")) - 1)
            part = data[offsets[a]:offsets[b]]
            found = self._lines(part, offsets[a:b + 1] - offsets[a], chosen)
            if found:
                yield (found[0] + a, *found[1:])
            a = b

    def _lines(self, data, offsets, chosen):
        h, first = self.tokens(data, offsets)
        if not len(h):
            return None
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        breaks = np.flatnonzero(data == 10)
        before = np.searchsorted(breaks, self.starts)
        line = before + doc  # rises with each line break and each text
        fresh = np.append(True, line[1:] != line[:-1])
        at = np.flatnonzero(fresh)
        ends = np.append(at[1:], len(h))
        number = (before[at] - np.searchsorted(breaks, offsets[:-1])[doc[at]])
        n = ends - at
        keys = []
        for j, base in enumerate(LINE_BASES):
            if len(self.line_powers[j][0]) <= len(h):
                self.line_powers[j] = tuple(np.cumprod(np.append(np.uint64(1), np.full(len(h), x, np.uint64))) for x in (base, pow(base, -1, 1 << 64)))
            powers, back = self.line_powers[j]
            sums = np.append(np.uint64(0), np.cumsum(mixed(h ^ np.uint64(base)) * powers[1:len(h) + 1]))
            keys.append(mixed((sums[ends] - sums[at]) * back[at] + n.astype(np.uint64)))
        mine = None if chosen is None else chosen(keys[0])
        k, own = self.shingle, np.cumsum(fresh) - 1
        whole = np.flatnonzero(n < k if mine is None else (n < k) & mine)
        if len(h) >= k:
            inside = own[k - 1:] == own[:len(h) - k + 1]
            inside = np.flatnonzero(inside if mine is None else inside & mine[own[k - 1:]])
            s = h[inside]
            for j in range(1, k):
                s = s * np.uint64(LINE_BASES[0]) + h[inside + j]
            owner, token = np.concatenate([own[inside], whole]), np.concatenate([mixed(s), keys[0][whole]])
        else:
            owner, token = whole, keys[0][whole]
        return doc[at], number, keys[0], keys[1], owner, token


class FirstSeen:
    """Masks of the lines that a task meets for the first time."""

    def __init__(self) -> None:
        self.seen = np.zeros(0, np.uint64)

    def __call__(self, h1: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
        own, first = np.unique(h1, return_index=True)
        new = np.ones(len(own), bool) if among is None else among[first]
        if len(self.seen):
            new &= self.seen[np.minimum(np.searchsorted(self.seen, own), len(self.seen) - 1)] != own
        self.seen = np.sort(np.concatenate([self.seen, own[new]]), kind="stable")
        mask = np.zeros(len(h1), bool)
        mask[first[new]] = True
        return mask


def rarity(cells: np.ndarray) -> np.ndarray:
    """The rank of each cell by (count, number)."""
    out = np.empty(len(cells), np.uint64)
    out[np.argsort(cells, kind="stable")] = np.arange(len(cells), dtype=np.uint64)
    return out


def ranked(owner: np.ndarray, token: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, token, position, size): distinct tokens of each line, the rarest first: in order of (rarity of
    the cell, rest of the token)."""
    low = np.uint64(64 - CELL_BITS)
    order = np.argsort(rarity[token >> low] << low | token & ((np.uint64(1) << low) - np.uint64(1)))
    lines = owner[order]
    if len(owner) and owner.max() < 1 << 16:
        lines = lines.astype(np.uint16)  # sorted by their digits
    order = order[np.argsort(lines, kind="stable")]
    owner, token = owner[order], token[order]
    once = np.append(True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1]))[:len(owner)]
    owner, token = owner[once], token[once]
    size = np.bincount(owner)
    start = np.cumsum(size) - size
    return owner, token, np.arange(len(owner)) - start[owner], size


def needed(size: np.ndarray, similar: Fraction) -> np.ndarray:
    """ceil(similar * size)"""
    return -(-size * similar.numerator // similar.denominator)


def batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v.view(np.int64) if v.dtype == np.uint64 else v)
                                       for v in columns.values()], list(columns))


class _Join:
    """The steps over one table of documents (id, text_hash, text)."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, similar: Fraction, shingle: int):
        self.similar, self.shingle = Fraction(similar), shingle
        self.docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
                                F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("text_hash"),
                                F.col(text_col).cast("string").alias("text"))

    def lines(self) -> tuple[DataFrame, DataFrame, np.ndarray]:
        """(written places of lines, line numbers of each document with a line, shingles per cell)"""
        shingle = self.shingle

        def rows(**columns):
            some = next(iter(columns.values()))
            return batch({c: columns.get(c, pa.nulls(len(some), t)) for c, t in types.items()})

        types = {"cell": pa.int32()} | dict.fromkeys(("h1", "h2", "id", "text_hash", "line"), pa.int64()) | {"numbers": pa.list_(pa.int64())}

        def run(batches):
            forget_held()
            hasher, cells = LineHasher(shingle), np.zeros(1 << CELL_BITS, np.int64)
            for b in batches:
                ids, texts = b.column(0).to_numpy(), b.column(1).to_numpy()
                for row, number, h1, h2, _, token in hasher.lines(b.column(2)):
                    cells += np.bincount((token >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
                    number = number.astype(np.int64)
                    first = np.append(True, row[1:] != row[:-1])  # a document's first line has the numbers of all
                    ends = np.append(np.flatnonzero(first), len(row))
                    offsets = np.append(ends[np.cumsum(first) - first], len(row)).astype(np.int32)
                    numbers = pa.ListArray.from_arrays(pa.array(offsets), pa.array(number), mask=pa.array(~first))
                    yield rows(h1=h1, h2=h2, id=ids[row], text_hash=texts[row], line=number, numbers=numbers)
            used = np.flatnonzero(cells)
            yield rows(cell=used.astype(np.int32), h1=cells[used])

        schema = "cell int, h1 long, h2 long, id long, text_hash long, line long, numbers array<bigint>"
        made = written(self.docs.mapInArrow(released(run), schema), "lines")
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for r in made.filter("cell is not null").groupBy("cell").agg(F.sum("h1").alias("n")).collect():
            cells[r["cell"]] = r["n"]
        return made.filter("line is not null").drop("cell", "numbers"), made.filter("numbers is not null").select("id", "text_hash", "numbers"), cells

    def postings(self, cells: np.ndarray) -> DataFrame:
        """Written rows (token, h1, size, pos, lead, near): each line of a posting but
        its earliest (lead), and whether the two pass the length and positional filters."""
        similar, shingle = self.similar, self.shingle

        def prefixes(batches):
            forget_held()
            hasher, order = LineHasher(shingle), rarity(cells)
            new = FirstSeen()  # a line once per task: copies leave it once
            for b in batches:
                ids = b.column(0).to_numpy()
                for row, _, h1, _, owner, token in hasher.lines(b.column(2), new):
                    owner, token, pos, size = ranked(owner, token, order)
                    head = pos < (size - needed(size, similar) + 1)[owner]
                    owner, token, pos = owner[head], token[head], pos[head]
                    yield batch({"token": token, "id": ids[row][owner], "h1": h1[owner], "at": size[owner].astype(np.int64) << 32 | pos})

        def runs(batches):
            last = None  # (token, id, h1, at) of the earliest line of the posting that goes on
            for b in batches:
                if not b.num_rows:
                    continue
                token, ids, h1, at = (c.to_numpy() for c in b.columns)
                fresh = np.append(last is None or token[0] != last[0], token[1:] != token[:-1])
                lead = np.maximum.accumulate(np.where(fresh, np.arange(len(token)), -1))
                carried = lead < 0
                lh, la = h1[lead], at[lead]
                if carried.any():
                    lh, la = np.where(carried, last[2], lh), np.where(carried, last[3], la)
                if not carried.all():
                    k = lead[-1]
                    last = (token[k], ids[k], h1[k], at[k])
                other = h1 != lh
                size, pos, lsize, lpos = at >> 32, at & 0xFFFFFFFF, la >> 32, la & 0xFFFFFFFF
                near = passes(size, pos, lsize, lpos, similar)
                yield batch({"token": token[other], "h1": h1[other], "size": size[other], "pos": pos[other], "lead": lh[other], "near": near[other]})

        rows = self.docs.mapInArrow(released(prefixes), "token long, id long, h1 long, at long")
        rows = rows.repartition("token").sortWithinPartitions("token", "id", "h1")
        return written(rows.mapInArrow(released(runs), "token long, h1 long, size long, pos long, lead long, near boolean"), "postings")

    def sets(self, wanted: DataFrame, classes: DataFrame) -> DataFrame:
        """Written sets (h1, h2, size, tokens, b0..b3, first) of the lines whose h1 is
        wanted. A bitmap of 2^FILTER_BITS bits (2 MB, whatever the input) filters lines where they are read;
        the semi-join makes it exact."""
        shingle, bits = self.shingle, np.zeros((1 << FILTER_BITS) // 8, np.uint8)
        slot = F.col("h1").bitwiseAND((1 << FILTER_BITS) - 1) + 1  # bit 0 of bucket 1 stands for 1
        maps = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
        for r in maps:  # each a piece of 4 KB
            piece = np.frombuffer(bytes(r["bits"]), np.uint8)
            bits[(r["bucket"] - 1) * len(piece):r["bucket"] * len(piece)] = piece

        def run(batches):
            forget_held()
            hasher, order, new = LineHasher(shingle), rarity(np.zeros(1 << CELL_BITS, np.int64)), FirstSeen()

            def chosen(h1):
                slot = (h1 & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                return new(h1, bits[slot >> 3] >> (slot & 7) & 1 > 0)

            for b in batches:
                for _, _, h1, h2, owner, token in hasher.lines(b.column(2), chosen):
                    if not len(owner):
                        continue
                    owner, token, _, size = ranked(owner, token, order)
                    lines = np.flatnonzero(size)
                    flips = np.zeros((len(size), 256), np.uint8)
                    np.bitwise_xor.at(flips, (owner, (token & np.uint64(255)).astype(np.int64)), 1)
                    maps = np.packbits(flips[lines], axis=1, bitorder="little").view(np.int64)
                    ends = np.append(0, np.cumsum(size[lines])).astype(np.int32)
                    yield batch({"h1": h1[lines], "h2": h2[lines], "size": size[lines].astype(np.int64),
                                 "tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64)))}
                                | {f"b{k}": np.ascontiguousarray(maps[:, k]) for k in range(4)})

        rows = self.docs.mapInArrow(released(run), "h1 long, h2 long, size long, tokens array<bigint>, b0 long, b1 long, b2 long, b3 long")
        rows = rows.join(wanted.select("h1").distinct(), "h1", "left_semi").dropDuplicates(["h1", "h2"])
        return written(rows.join(classes.select("h1", "h2", "first"), ["h1", "h2"]), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """(h1, h2) of the later line of each pair (x, y) of line keys whose sets are similar."""
        x = sets.select(*[F.col(c).alias(f"x_{c}") for c in ("h1", "h2", "size", "tokens", "first")])
        y = sets.select(*[F.col(c).alias(f"y_{c}") for c in ("h1", "h2", "size", "tokens", "first")])
        both = pairs.join(x, F.col("x") == F.col("x_h1")).join(y, F.col("y") == F.col("y_h1"))
        shared = F.size(F.array_intersect("x_tokens", "y_tokens"))
        t = self.similar
        alike = shared * (t.numerator + t.denominator) >= (F.col("x_size") + F.col("y_size")) * t.numerator
        later = F.when(F.col("x_first") > F.col("y_first"), F.struct(F.col("x_h1").alias("h1"), F.col("x_h2").alias("h2"))) \
            .when(F.col("x_first") < F.col("y_first"), F.struct(F.col("y_h1").alias("h1"), F.col("y_h2").alias("h2")))
        return both.filter(alike).select(later.alias("later")).filter("later is not null").select("later.*").distinct()

    def matched(self, classes: DataFrame, cells: np.ndarray) -> DataFrame:
        """Written (h1, h2) of the classes that have an earlier similar class."""
        postings = self.postings(cells)
        wanted = written(postings.select("h1").union(postings.select("lead")).distinct(), "wanted")
        sets = self.sets(wanted, classes)
        discard_written(wanted)
        maps = ["b0", "b1", "b2", "b3"]
        lines = postings.select("token", "h1", "pos").distinct().join(sets.select("h1", "h2", "size", "first", *maps), "h1")
        lines = written(lines, "posted")
        t = self.similar
        apart = sum((F.bit_count(F.col(f"x_{m}").bitwiseXOR(F.col(f"y_{m}"))) for m in maps), F.lit(0))
        alike = apart * (t.numerator + t.denominator) <= (F.col("x_size") + F.col("y_size")) * (t.denominator - t.numerator)
        # Pairs are written before their sets are fetched, so that few pairs are taken to the sets, not all sets to the pairs.
        x, y = (sets.select(*[F.col(c).alias(f"{side}_{c}") for c in ("h1", "size", *maps)]) for side in "xy")
        pairs = postings.filter("near").select("h1", "lead").distinct()
        pairs = pairs.join(x, F.col("h1") == F.col("x_h1")).join(y, F.col("lead") == F.col("y_h1")).filter(alike)
        pairs = written(pairs.select(F.col("x_h1").alias("x"), F.col("y_h1").alias("y")).distinct(), "pairs")
        discard_written(postings)
        settled = written(self.verified(pairs, sets), "settled")
        x = lines.join(settled, ["h1", "h2"], "left_anti").select(*[F.col(c).alias(f"x_{c}") for c in lines.columns])
        y = lines.select(*[F.col(c).alias(f"y_{c}") for c in lines.columns])
        rest = x.join(y, (F.col("x_token") == F.col("y_token")) & (F.col("y_first") < F.col("x_first"))
                      & passes(F.col("x_size"), F.col("x_pos"), F.col("y_size"), F.col("y_pos"), t) & alike)
        rest = written(rest.select(F.col("x_h1").alias("x"), F.col("y_h1").alias("y")).distinct(), "rest")
        discard_written(pairs, lines)
        more = self.verified(rest, sets)
        found = written(settled.union(more).distinct(), "matched")
        discard_written(sets, settled, rest)
        return found


def passes(size, pos, other_size, other_pos, t: Fraction):
    """Length and positional filter for a token shared at two positions; on
    numpy arrays or on Columns. Shared tokens are at most those up to the
    earlier position, and what is left after both."""
    columns = isinstance(size, Column)
    least, most = (F.least, F.greatest) if columns else (np.minimum, np.maximum)
    bound = least(pos, other_pos) + 1 + least(size - pos - 1, other_size - other_pos - 1)
    return (least(size, other_size) * t.denominator >= most(size, other_size) * t.numerator) \
        & (bound * (t.numerator + t.denominator) >= (size + other_size) * t.numerator)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: Fraction = SIMILAR,
                  shingle: int = SHINGLE) -> DataFrame:
    """Per distinct (id, text_hash) with a line: n_lines, removed (ascending
    line numbers, from 0, of the lines to remove). Null ids are LAST here."""
    join = _Join(docs, id_col, text_col, similar, shingle)
    places, documents, cells = join.lines()
    classes = written(places.groupBy("h1", "h2").agg(F.min(F.struct("id", "text_hash", "line")).alias("first")), "classes")
    matched = join.matched(classes, cells)
    stays = classes.join(matched, ["h1", "h2"], "left_anti").select("first.*")
    stays = stays.groupBy("id", "text_hash").agg(F.collect_list("line").alias("stays"))
    found = documents.dropDuplicates(["id", "text_hash"]).join(stays, ["id", "text_hash"], "left")
    none = F.array().cast("array<bigint>")
    return found.select("id", "text_hash", F.size("numbers").cast("long").alias("n_lines"),
                        F.array_except("numbers", F.coalesce("stays", none)).alias("removed"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_lines (with a word), n_removed, removed_lines."""
    found = removed_lines(docs, id_col, text_col, **options)
    keys = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
                       F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("text_hash"))
    none = F.array().cast("array<bigint>")
    return keys.join(found, ["id", "text_hash"], "left").select(
        F.col("key").alias(id_col), F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", none).alias("removed_lines"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of their texts; a text
    may end up empty. ``chars_col``, if given, is set to the new length."""
    key, text_hash, n, gone = new_names(docs.columns, "id", "hash", "lines", "removed")
    found = removed_lines(docs, id_col, text_col, **options).toDF(key, text_hash, n, gone).filter(F.size(gone) > 0)
    rows = docs.withColumns({key: F.coalesce(docs[id_col].cast("long"), F.lit(LAST)), text_hash: F.coalesce(F.xxhash64(docs[text_col]), F.lit(0))})
    rows = rows.join(found, [key, text_hash], "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(gone, i.cast("long"))), "\n")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept)
    rows = rows.withColumn(text_col, text)
    if chars_col:
        rows = rows.withColumn(chars_col, F.length(text_col).cast(dict(docs.dtypes)[chars_col]))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
