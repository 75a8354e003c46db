"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Documents become token pieces (only documents longer than the capacity are
cut). A full piece is a sequence by itself. Every document has at most one
shorter piece; all of these are packed by one best-fit decreasing: pieces in
falling length go to the open sequence with the least room that still fits,
found in a segment tree over the remaining room in logarithmic time.

Where a piece goes depends on the lengths only, and equal lengths are placed in a row. So the
plan is made on the number of pieces per length (fewer than ``capacity`` numbers, whatever the
input): open sequences of equal room are kept as intervals, and a placement is a run of equal pieces over
an interval. The plan has a few runs per length. Pieces then get their rank in falling length by a
distributed sort of slim rows, and the run that holds its rank tells a piece's sequence and offset. The number of
sequences is that of the one packing, whatever the partitioning.

Defined results: null and empty texts are documents of one token (the end
id); very long texts are encoded whole and cut; repeated rows and ids are packed one by one; an empty table gives an empty result;
extra columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import numbered, released, written
from lendwise.llm.tokenization import END_ID, tokenizer_path, worker_encoder

CAPACITY = 4096
#: Text bytes encoded at a time: few, as packing follows other stages in the same workers.
SPAN = 1 << 20


class RoomTree:
    """Segment tree over remaining room 0..capacity; a node tells whether any
    open sequence has room in its range. Sequences of equal room are intervals (first, number)."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.base)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, number: int) -> None:
        self.open[room].append((first, number))
        node = self.base + room
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, room: int) -> tuple[int, int]:
        """Remove and return an interval of sequences with exactly this room."""
        interval = self.open[room].pop()
        if not self.open[room]:
            node = self.base + room
            self.some[node] = 0
            node >>= 1
            while node and not (self.some[2 * node] or self.some[2 * node + 1]):
                self.some[node] = 0
                node >>= 1
        return interval

    def tightest(self, need: int) -> int | None:
        """The least room of any open sequence that is at least ``need``."""
        node = self.base + need
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.base


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (first rank, length, pieces per sequence, first sequence, offset) of all pieces in falling
    length; ``counts`` has the number of pieces of each length. A sequence that a piece went to is the tightest for the next of
    its length while it fits, so it takes room // length of them in a row."""
    tree, runs, rank, sequences = RoomTree(capacity), [], 0, 0
    for n, left in sorted(counts.items(), reverse=True):
        while left:
            room = tree.tightest(n)
            if room is None:
                first, number, room = sequences, -(-left // (capacity // n)), capacity
                sequences += number
            else:
                first, number = tree.take(room)
            each = room // n
            full = min(number, left // each)
            rest = min(left - full * each, each - 1) if full < number else 0
            if full:
                runs.append((rank, n, each, first, capacity - room))
                if room - each * n:
                    tree.add(room - each * n, first, full)
            if rest:
                runs.append((rank + full * each, n, rest, first + full, capacity - room))
                if room - rest * n:
                    tree.add(room - rest * n, first + full, 1)
            unused = number - full - (rest > 0)
            if unused:
                tree.add(room, first + number - unused, unused)
            rank, left = rank + full * each + rest, left - full * each - rest
    return runs


def place(runs: list[tuple[int, int, int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ranked pieces (.., rank from 1 last) to placed ones (.., sequence_id, offset)."""
    first, length, each, sequence, offset = np.array(runs, np.int64).reshape(-1, 5).T

    def run(batches):
        for b in batches:
            rank = b.column(b.num_columns - 1).to_numpy() - 1
            k = np.searchsorted(first, rank, "right") - 1
            at = rank - first[k]
            places = [pa.array(sequence[k] + at // each[k]), pa.array(offset[k] + at % each[k] * length[k])]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *places], [*b.schema.names[:-1], "sequence_id", "offset"])

    return run


def cut(path: str, end_id: int, capacity: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (id, text) to pieces (id, piece, start, length, ids_crc32, whole, row[, ids]); ``row``
    is the piece's own number, ``whole`` that of a full one."""
    def run(batches):
        encoder, made = worker_encoder(path), TaskContext.get().partitionId() << 36
        for batch in batches:
            rows, out = [], {k: [] for k in ("piece", "start", "length", "ids_crc32", "whole", "row", "ids")}
            for row, document in enumerate(encoder.documents(batch.column(1), end_id, SPAN)):
                ids = memoryview(document).cast("B")
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    full = len(part) == 4 * capacity
                    made += 1
                    rows.append(row)
                    for k, v in zip(out, (piece, at // 4, len(part) // 4, zlib.crc32(part), made if full else None, made,
                                          bytes(part) if keep_ids else None), strict=True):
                        out[k].append(v)
            types = {"piece": pa.int32(), "ids": pa.binary()}
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(v, types.get(k, pa.int64())) for k, v in out.items() if keep_ids or k != "ids"]
            yield pa.RecordBatch.from_arrays(columns, ["id", *[k for k in out if keep_ids or k != "ids"]])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
         capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and, with ``keep_ids``, ids as little-endian unsigned 32-bit)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(source.dtypes)["id"]
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, whole long, row long" + ", ids binary" * keep_ids
    pieces = written(source.mapInArrow(released(cut(tokenizer or tokenizer_path(), end_id, capacity, keep_ids)), schema), "pieces")
    # ``row`` tells repeated rows apart, so that a hot document is spread over the ranges too.
    short = pieces.filter("whole is null").select("id", "piece", F.col("start").alias("begin"), "length", "ids_crc32", "row")
    counts = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}  # fewer than ``capacity``
    ranked = numbered(short, [F.desc("length"), F.col("row")], "ranked") if counts else short.withColumn("rank", F.lit(0).cast("long"))
    columns = ["id", "piece", F.col("begin").alias("start"), "length", "ids_crc32", "row"]
    result = f"id {kind}, piece int, start long, length long, ids_crc32 long, row long, sequence_id long, offset long"
    packed = ranked.select(*columns, "rank").mapInArrow(released(place(best_fit_decreasing(counts, capacity))), result)
    whole = pieces.filter("whole is not null").select(
        "id", "piece", "start", "length", "ids_crc32", "row", F.col("whole").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = packed.unionByName(whole)
    if keep_ids:
        out = out.join(pieces.select("row", "ids"), "row")
    return out.drop("row").withColumnRenamed("id", id_col)
