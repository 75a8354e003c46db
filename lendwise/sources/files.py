"""File sources and sinks (S1-S5, S8, S11, S12) and JDBC sinks.

Readers take explicit schemas (no inference pass over the data); sinks are
plain DataFrame writers. Shared folders come from ``spark.checkpoint.dir``
(``session.checkpoint_dir``), never a machine-local temp dir.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.schema import LOAN_SCHEMA, nan_to_null, normalise_name, normalise_names
from lendwise.session import checkpoint_dir


# Values are written and read exactly: nothing trimmed, quotes doubled as other tools write them,
# and an empty text (quoted) told from a null (nothing). A null is named on reading because the source
# takes the empty text for null otherwise.
EXACT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quote": '"', "escape": '"'}
READ_EXACT = EXACT | {"nullValue": "\u0000null", "emptyValue": "", "enforceSchema": True}
MAX_HEADERS = 1_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lendwise-{name}-{uuid.uuid4().hex}"


def raw_schema(schema: T.StructType, header: list[str]) -> T.StructType:
    """Map a normalised schema onto a file's raw header names (for CSV)."""
    by_norm = {f.name: f for f in schema.fields}
    fields = []
    for h in header:
        f = by_norm.get(normalise_name(h))
        fields.append(T.StructField(h, f.dataType if f else T.StringType(), True))
    return T.StructType(fields)


def csv_layout(spark: SparkSession, path) -> list[dict]:
    """Groups of files that may be read together, from one pass over the lines: ``header`` (their first line), ``broken``
    (whether some line has an unclosed quote, so that values hold line breaks) and ``files``."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    files = lines.groupBy("file_path").agg(F.min_by("value", F.struct("file_block_start", "at")).alias("header"), F.max(odd).alias("broken"))
    groups = files.groupBy("header", "broken").agg(F.sort_array(F.collect_list("file_path")).alias("files")).limit(MAX_HEADERS + 1).collect()
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}")
    return [{"header": g["header"], "broken": g["broken"], "files": [unquote(f) for f in g["files"]]} for g in sorted(groups, key=lambda g: (g["header"], g["broken"]))]


def read_csv(spark: SparkSession, path: str, schema: T.StructType = LOAN_SCHEMA,
             normalise: bool = True, checked: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (by normalised name), so
    no inference pass is made; names normalised (P1).

    ``checked`` looks at the lines first (one pass over the text): files are read by
    their own header, so columns in another order, or missing, go where their name says; files with line
    breaks inside quotes are read whole, one task each, the others in splits. Without it the
    caller states that all files have the first one's header and one line per record; a
    row of another number of columns is then an error, never a broken row."""
    if not checked:
        header = spark.read.options(**READ_EXACT).csv(path).columns  # reads the first line only
        return _read_csv(spark, path, schema, header, normalise, {"mode": "FAILFAST"})
    parts = []
    for g in csv_layout(spark, path):
        options = {"multiLine": bool(g["broken"]), "mode": "FAILFAST"}
        header = spark.read.options(**READ_EXACT | options).csv(g["files"][0]).columns
        parts.append(_read_csv(spark, g["files"], schema, header, normalise, options))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _read_csv(spark: SparkSession, path, schema: T.StructType, header: list[str], normalise: bool, options: dict) -> DataFrame:
    df = nan_to_null(spark.read.options(**READ_EXACT | options).schema(raw_schema(schema, header)).csv(path))
    return normalise_names(df) if normalise else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header; key columns are kept as ordinary columns."""
    df.write.mode(mode).options(**EXACT).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S2; NaN becomes null, the only missing marker."""
    return nan_to_null(spark.read.parquet(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """S5."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop: works for HDFS and object stores, not only local disks."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def publish(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file that appears whole or not at all: written under another name, then renamed."""
    fs, p = _hadoop(spark, path)
    _, hidden = _hadoop(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(hidden)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(hidden, p):
        raise OSError(f"{path} could not be published")


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (without hidden ones), in order; none where there is no folder."""
    fs, p = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n[0] not in "._")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def cached_or_compute(spark: SparkSession, path: str, compute, fmt: str = "parquet") -> DataFrame:
    """Reuse stored output if it is complete (its ``_SUCCESS`` mark exists), else compute, write and read it
    back (the written table also cuts the lineage)."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        compute().write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def preview(df: DataFrame, order, n: int = 20) -> DataFrame:
    """First ``n`` rows after a deterministic sort (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def with_partitions(df: DataFrame, n: int | None = None, coalesce_to: int | None = None) -> DataFrame:
    """Explicit partition count. ``None`` leaves it to AQE, which is the
    default: a fixed repartition adds a full shuffle."""
    if n is not None:
        df = df.repartition(n)
    if coalesce_to is not None:
        df = df.coalesce(coalesce_to)
    return df


def partition_count(df: DataFrame) -> int:
    """S12's "report count". Note: on a plan with shuffles, AQE runs those
    stages to know the final partitioning - call it on scans or written data."""
    return df.rdd.getNumPartitions()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None) -> None:
    """S6a (``append``) / S6b (``overwrite``): RDBMS sink through the JDBC
    data source; each partition writes over its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=properties or {})


def json_strings(df: DataFrame) -> DataFrame:
    """Rows as JSON strings (the message format of the stream source)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
