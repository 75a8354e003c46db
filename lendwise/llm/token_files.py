"""Token-ID files: fixed-width bit packing.

A shard file holds the ids of documents in ascending id order, every id in the
fewest bits that hold the vocabulary, least significant bit first:

    magic, bits, ids per block        (8 bytes, two unsigned 32-bit numbers)
    blocks                            (each ``block`` ids packed, the last fewer)
    footer: block offsets             (unsigned 64-bit, one per block)
            document starts           (unsigned 64-bit, one per document and the end)
            document ids, null flags  (signed 64-bit, one byte)
    blocks, documents, footer offset, magic   (three unsigned 64-bit numbers, 8 bytes)

All numbers are little-endian. Block offsets and document starts give random access: any range of
ids is unpacked by numpy from the blocks that hold it. Shards are range
partitions of the id, written by their tasks to the shared folder under a
temporary name and renamed, so that a repeated task replaces its own file.

Defined results: null and empty texts are the end id alone; very long texts are encoded whole; null document ids
come first; equal ids are ordered by text; an empty table gives no shards; extra columns do not matter.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.llm.tokenization import END_ID, VOCABULARY, tokenizer_path, worker_encoder

MAGIC, BLOCK = b"LWTOKEN1", 1 << 16
#: Text bytes per shard; above SHARDS shards they grow instead, so the manifest stays bounded.
SHARD_BYTES, SHARDS = 32 << 20, 1 << 16


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def packed(ids: np.ndarray, bits: int) -> bytes:
    """Ids (unsigned 32-bit) in ``bits`` bits each."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, :bits // 8].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpacked(data: bytes, bits: int, count: int) -> np.ndarray:
    out = np.zeros((count, 4), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    if bits % 8 == 0:
        out[:, :bits // 8] = raw[:count * bits // 8].reshape(count, bits // 8)
    else:
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :bits] = np.unpackbits(raw, bitorder="little")[:count * bits].reshape(count, bits)
        out = np.packbits(wide, axis=1, bitorder="little")
    return out.view("<u4").reshape(count)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """Any store that pyarrow reaches (local and shared mounts, HDFS, object stores)."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class ShardWriter:
    """Streams ids into blocks; holds one block and the document table."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.waiting: list[np.ndarray] = []
        self.n = self.held = self.at = 0
        self.offsets, self.starts, self.ids = [], [0], []
        self._put(MAGIC + np.array([bits, block], "<u4").tobytes())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.n += len(ids)
        self.starts.append(self.n)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        end = len(ids) if last else len(ids) - len(ids) % self.block
        for at in range(0, end, self.block):
            self.offsets.append(self.at)
            self._put(packed(ids[at:min(at + self.block, end)], self.bits))
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        footer = self.at
        self._put(np.array(self.offsets, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self._put(np.array([d or 0 for d in self.ids], "<i8").tobytes() + bytes(d is None for d in self.ids))
        self._put(np.array([len(self.offsets), len(self.ids), footer], "<u8").tobytes() + MAGIC)


class ShardReader:
    """Random access to a shard: ``ids(a, b)``, ``document(k)``."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(32, size - 32)
        if tail[24:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        blocks, docs, self.footer = map(int, np.frombuffer(tail, "<u8", 3))
        self.bits, self.block = map(int, np.frombuffer(self.file.read_at(8, 8), "<u4"))
        raw = self.file.read_at(size - 32 - self.footer, self.footer)
        self.offsets = np.frombuffer(raw, "<u8", blocks).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 8 * blocks).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * (blocks + docs + 1))
        self.null = np.frombuffer(raw, np.uint8, docs, 8 * (blocks + 2 * docs + 1)).astype(bool)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a..b-1 of the shard, from the blocks that hold them."""
        if a >= b:
            return np.zeros(0, "<u4")
        first, last = a // self.block, (b - 1) // self.block
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.footer
        out = []
        data = self.file.read_at(end - int(self.offsets[first]), int(self.offsets[first]))
        for k in range(first, last + 1):
            count = min(self.block, int(self.starts[-1]) - k * self.block)
            at = int(self.offsets[k] - self.offsets[first])
            out.append(unpacked(data[at:at + -(-count * self.bits // 8)], self.bits, count))
        return np.concatenate(out)[a - first * self.block:b - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self, span: int = 1 << 22) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, start, ids) of every document, about ``span`` ids at a time."""
        k, n = 0, len(self.doc_ids)
        while k < n:
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + span, "right")) - 1)
            ids, base = self.ids(int(self.starts[k]), int(self.starts[end])), int(self.starts[k])
            for d in range(k, end):
                yield (None if self.null[d] else int(self.doc_ids[d])), int(self.starts[d]), \
                    ids[self.starts[d] - base:self.starts[d + 1] - base]
            k = end


def shard_writer(uri: str, tokenizer: str, end_id: int, bits: int, block: int) -> Callable:
    def run(batches):
        store, folder = file_system(uri)
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}.tok"
        temporary, writer, encoder = f"{folder}/.{name}.{uuid.uuid4().hex}", None, None
        for batch in batches:
            if writer is None and batch.num_rows:
                encoder = worker_encoder(tokenizer)
                out = store.open_output_stream(temporary)
                writer = ShardWriter(out, bits, block)
            if batch.num_rows:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.documents(batch.column(1), end_id), strict=True):
                    writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            out.close()
            store.move(temporary, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"shard": pa.array([task.partitionId()], pa.int32()), "name": [name],
                                              "docs": pa.array([len(writer.ids)], pa.int64()), "tokens": pa.array([writer.n], pa.int64())})

    return run


def write_token_files(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                      end_id: int = END_ID, vocabulary: int = VOCABULARY, block: int = BLOCK, shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Write the shards and ``manifest.json`` (shard, name, docs, tokens, start) under ``uri``;
    returns the manifest, of at most SHARDS rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = int(min(SHARDS, max(1, -(-total // shard_bytes))))
    store, folder = file_system(uri)
    store.create_dir(folder, recursive=True)
    ordered = rows.repartitionByRange(shards, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    write = shard_writer(uri, tokenizer or tokenizer_path(), end_id, bits_for(vocabulary), block)
    manifest, start = [], 0
    for r in sorted(ordered.mapInArrow(write, "shard int, name string, docs long, tokens long").collect()):
        manifest.append(r.asDict() | {"start": start})
        start += r["tokens"]
    with store.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_token_files(spark: SparkSession, uri: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    store, folder = file_system(uri)
    with store.open_input_stream(f"{folder}/manifest.json") as file:
        manifest = json.loads(file.read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    if not manifest:
        return spark.createDataFrame([], schema)
    shards = spark.createDataFrame([(k, m["name"], m["start"]) for k, m in enumerate(manifest)], "k int, name string, base long")

    def run(batches):
        store, folder = file_system(uri)
        for batch in batches:
            for name, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows: list[tuple] = []
                for doc_id, start, ids in ShardReader(store, f"{folder}/{name}").documents():
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids), *([ids.astype(np.int32)] if with_ids else [])))
                    if len(rows) == 2_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    types = [pa.int64()] * 4 + [pa.list_(pa.int32())]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return shards.repartitionById(len(manifest), F.col("k")).mapInArrow(run, schema)
