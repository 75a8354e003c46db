"""Exact dedup (native): an extendible-hash index on shared files.

1. ``keys``: one slim row per document (id, 64-bit hash, SHA-256), written to
   the shared folder.
2. The directory: a bucket that holds more than ``capacity`` distinct hashes
   is split by its next hash bit; where it already uses all bits of the
   directory, the directory doubles first. It works on distinct hashes, so
   copies never overfill a bucket, and has at most 2^max_depth slots.
   Above capacity * 2^max_depth distinct hashes buckets stay overfull.
3. Rows meet by (hash, SHA-256, text) in Spark's hash shuffle: the group-by on the text is the
   comparison of bytes and finds the groups, it runs map-side first, so a text held by a third
   of all rows leaves each task once. Texts with one hash are separate entries. Only then
   are entries (without texts) dealt by bucket to owner tasks, which own contiguous ranges of
   buckets, sort them and write the index files; buckets take no part in the dedup.
4. Each document looks its entry up by (hash, SHA-256). The few groups above a
   thousandth of all rows (at most 1,000, so a bounded broadcast) are
   looked up without a shuffle. Should two different texts ever share hash and
   SHA-256, their documents are looked up by text instead.

Defined results: null text counts as empty text; very long texts are hashed and compared whole; the row with the largest id
of a group stays, null ids rank lowest; of rows repeated with the same id and
text one stays; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.llm.common import fresh_path, looked_up, written


def directory(cells: dict[int, int], max_depth: int, capacity: int) -> tuple[int, list[int]]:
    """Extendible hashing over the counts of distinct hashes per cell of
    ``max_depth`` leading bits: (global depth, bucket of each slot)."""
    depth, leaves, todo = 0, [], [(0, 0, sum(cells.values()), cells)]
    while todo:
        prefix, local, n, own = todo.pop()
        if n <= capacity or local == max_depth:
            leaves.append((prefix, local))
            continue
        depth = max(depth, local + 1)  # the directory doubles where the bucket used all its bits
        bit = max_depth - local - 1
        for b in (0, 1):
            half = {c: k for c, k in own.items() if c >> bit & 1 == b}
            todo.append((prefix << 1 | b, local + 1, sum(half.values()), half))
    slots = [0] * (1 << depth)
    for bucket, (prefix, local) in enumerate(sorted(leaves, key=lambda p: p[0] << (max_depth - p[1]))):
        for slot in range(prefix << (depth - local), (prefix + 1) << (depth - local)):
            slots[slot] = bucket
    return depth, slots


def leading(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


def build_index(docs: DataFrame, id_col: str, text_col: str, capacity: int = 4096, max_depth: int = 14,
                hash_of=F.xxhash64, digest_of=lambda t: F.unhex(F.sha2(t, 256))) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keys, index, texts): written slim rows, the written index, and the rows with their texts (lazy)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", "t", hash_of(F.col("t")).alias("h"), digest_of(F.col("t")).alias("d"))
    keys = written(texts.groupBy("id", "h", "d").agg(F.count(F.lit(1)).alias("copies")), "keys")
    cells = keys.select("h").distinct().groupBy(leading(F.col("h"), max_depth).alias("cell")).count().collect()
    depth, slots = directory({r["cell"]: r["count"] for r in cells}, max_depth, capacity)
    buckets = slots[-1] + 1
    table = spark.createDataFrame(pd.DataFrame({"slot": range(len(slots)), "bucket": slots}), "slot long, bucket long")
    owners = int(min(buckets, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    entries = (texts.groupBy("h", "d", "t").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .withColumn("slot", leading(F.col("h"), depth)).drop("t").join(F.broadcast(table), "slot")
               .repartitionById(owners, (F.col("bucket") * owners / buckets).cast("int"))
               .sortWithinPartitions("bucket", "h", "d"))
    path = fresh_path(spark, "index")
    entries.select("bucket", "h", "d", "keep_id", "group_size").write.parquet(path)
    return keys, spark.read.schema("bucket long, h long, d binary, keep_id " + dict(entries.dtypes)["keep_id"] + ", group_size long").parquet(path), texts


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    keys, index, texts = build_index(docs, id_col, text_col, **options)
    entry = index.select("h", "d", "keep_id", "group_size")
    clash = index.groupBy("h", "d").count().filter("count > 1").select("h", "d")
    exact = None
    if not clash.isEmpty():  # different texts with one hash and digest: their documents are told apart by text
        same = texts.join(clash, ["h", "d"], "left_semi")
        chains = same.groupBy("h", "d", "t").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        exact = same.groupBy("id", "h", "d", "t").agg(F.count(F.lit(1)).alias("copies")).join(chains, ["h", "d", "t"])
        keys, entry = (x.join(clash, ["h", "d"], "left_anti") for x in (keys, entry))
    columns = ["id", "d", "copies", "keep_id", "group_size"]
    found = looked_up(keys, entry, ["h", "d"], "group_size").select(columns)
    found = found if exact is None else found.union(exact.select(columns))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.withColumn("copy", copy).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("d")).alias("text_sha256"))
