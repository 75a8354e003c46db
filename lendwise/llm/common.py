"""Shared helpers: the shared folder, written tables, words, checked broadcasts."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: white space between words (the same text is a Java, Python and RE2 class).
WHITE_SPACE = r"\x20\x09-\x0D"
WORD = f"[^{WHITE_SPACE}]+"

#: A derived side is broadcast only when its measured size is below this.
BROADCAST_BYTES = 8 << 20


#: Under this name a Python worker holds what token encoders have learned.
HELD = "lendwise_worker_encoders"


def forget_held() -> None:
    """Called by tasks that need the worker's memory for themselves: workers
    outlive stages, so an earlier stage's word memory would add to theirs."""
    sys.modules.pop(HELD, None)


def released(run):
    """``run`` (batches to batches), after which the task's freed memory goes
    back to the system: workers outlive stages, and what their allocators
    keep would add to the next stage's."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)
    return task


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Set here only where it is
    unset and the master is local, as in tests; on a cluster an unset folder is
    an error, because machine-local folders are not shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="lendwise-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lendwise-llm/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that this job wrote to the shared folder and no longer reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard_written(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no result reads any more."""
    for table in tables:
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            discard(table.sparkSession, path)


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (without columns at, part, start) written in the order, with ``rank`` 1, 2, ...: ranges of
    the order are sorted in their tasks, and only a count per range reaches the driver."""
    ranked = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()), name)
    part, before, starts = F.shiftright("at", 33), 0, []
    for r in ranked.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before + 1))
        before += r["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.withColumn("part", part).join(F.broadcast(offsets), "part").select(*rows.columns, rank.alias("rank"))


def word_array(text: Column) -> Column:
    """Words of ``text`` in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE_SPACE}]+"), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_enough(df: DataFrame, *strings: str) -> bool:
    """Whether a table (already written) may be broadcast: its measured rows
    and string bytes stay below BROADCAST_BYTES."""
    size = F.count(F.lit(1)) * (32 + 16 * len(df.columns))
    for s in strings:
        size = size + F.coalesce(F.sum(F.octet_length(s)), F.lit(0))
    return df.agg(size.alias("bytes")).first()["bytes"] <= BROADCAST_BYTES


def new_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names for temporary use that no existing column has, whatever
    its case."""
    used = {t.lower() for t in taken}
    out = []
    for w in wanted:
        name, k = f"_lw_{w}", 0
        while name.lower() in used:
            k += 1
            name = f"_lw_{w}_{k}"
        used.add(name.lower())
        out.append(name)
    return out


def looked_up(rows: DataFrame, entries: DataFrame, on: list[str], share_of: str) -> DataFrame:
    """Inner join of rows to a written table with one entry per key, whose
    column ``share_of`` says how many rows the key has. The keys above a
    thousandth of all rows (at most 1,000, so a bounded broadcast) are joined without a
    shuffle; the rest shuffles, with no hot key left."""
    total = entries.agg(F.coalesce(F.sum(share_of), F.lit(0)).alias("n")).first()["n"]
    large = F.broadcast(entries.filter(F.col(share_of) > total / 1000))
    rest = entries.filter(F.col(share_of) <= total / 1000)
    return rows.join(large, on).unionByName(rows.join(large.select(on), on, "left_anti").join(rest, on))
