"""Streaming clean (T1-T6): JSON loan messages -> fitted transform -> table.

* Source (T1): Kafka (``format("kafka")``, topic, ``startingOffsets``, ``latest`` by default as
  the reference reads) when a broker is given, else a folder of text files with one JSON value per line.
  Both yield a ``value`` string and its ``origin`` (topic, partition and offset, or the file).
* End of stream (T3): a message that is the JSON string ``"EOF"`` marks the
  end; sentinel rows are filtered out, and the query stops after the
  micro-batch that contained one.
* Decode: ``from_json`` with an explicit schema. A message that is no JSON object of that
  schema does not stop the stream: it becomes a dead letter (raw text, error, origin).
* Transform (T4): ``LoanPrepModel.transform`` on the *streaming* DataFrame -
  the same projections as batch, with stored parameters.
* Sink (T5): ``foreachBatch`` writes each micro-batch's clean rows and dead letters in one pass
  and then commits them (``sink.CommittedTable``): readers see whole batches, a replay changes nothing.
* T6: batch load first, then the stream appends.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendwise.plans.pipeline import LoanPrepModel
from lendwise.schema import LOAN_SCHEMA
from lendwise.streaming.sink import CLEAN, DEAD, KIND, CommittedTable

SENTINEL = "EOF"
EOF_COL, DEAD_COL, CORRUPT = "_eof", "_dead", "_corrupt"


def message_schema(raw_names: dict[str, str] | None = None,
                   schema: T.StructType = LOAN_SCHEMA) -> T.StructType:
    """Schema of one message; ``raw_names`` maps normalised -> raw field names."""
    raw_names = raw_names or {}
    return T.StructType([T.StructField(raw_names.get(f.name, f.name), f.dataType, True)
                         for f in schema.fields])


def read_messages(spark: SparkSession, path: str | None = None, kafka_servers: str | None = None,
                  topic: str | None = None, starting_offsets: str = "latest",
                  max_files_per_trigger: int | None = None,
                  max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame with one ``value`` string per message and its ``origin``; the
    limits bound one micro-batch. ``starting_offsets`` holds for the first start of a query
    only; a producer that starts before the consumer needs ``earliest``."""
    if kafka_servers:
        limit = {"maxOffsetsPerTrigger": max_offsets_per_trigger} if max_offsets_per_trigger else {}
        return (spark.readStream.format("kafka").options(**limit)
                .option("kafka.bootstrap.servers", kafka_servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .load().select(F.col("value").cast("string").alias("value"),
                               F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias("origin")))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("value", F.col("_metadata.file_path").alias("origin"))


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON value -> typed columns, ``_eof`` for the sentinel message and ``_dead``, a struct (value,
    error, origin), for a message that is no JSON object of the schema; the typed columns of
    such a row are null. Blank messages hold nothing and are left out."""
    v = F.trim(F.col("value"))
    eof = v == F.lit(f'"{SENTINEL}"')
    target = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rec = F.from_json(F.when(v.startswith("{"), v), target, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    origin = F.col("origin") if "origin" in messages.columns else F.lit(None).cast("string")
    rows = messages.where(v != "").select("value", origin.alias("_origin"), eof.alias(EOF_COL), rec.alias("r"))
    error = F.when(~F.trim("value").startswith("{"), "no JSON object").when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), "malformed JSON, or a value of another type")
    dead = F.when(~F.col(EOF_COL) & error.isNotNull(), F.struct("value", error.alias("error"), F.col("_origin").alias("origin")))
    rows = rows.select("r", EOF_COL, dead.alias(DEAD_COL))
    return rows.select(*[F.when(F.col(DEAD_COL).isNull(), F.col("r").getField(f.name)).alias(f.name) for f in schema.fields], EOF_COL, DEAD_COL)


class _StopFlag:
    def __init__(self):
        self.event = threading.Event()


def clean_stream(spark: SparkSession, model: LoanPrepModel, messages: DataFrame, schema: T.StructType,
                 sink: str, checkpoint: str, trigger: dict | None = None) -> tuple[StreamingQuery, _StopFlag]:
    """T4 + T5: start the cleaning query; returns (query, stop flag)."""
    cleaned = model.transform(decode(messages, schema))
    flag, table = _StopFlag(), CommittedTable(spark, sink)
    plain = [c for c in cleaned.columns if c not in (EOF_COL, DEAD_COL)]
    table.declare(CLEAN, cleaned.select(*plain).schema)
    table.declare(DEAD, cleaned.select(f"{DEAD_COL}.*").schema)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream_id(spark, checkpoint)}-{batch_id:012d}"
        eof = {"eof": F.max(F.col(EOF_COL).cast("int"))}
        if table.committed(name):  # replayed after its commit
            seen_eof = batch.agg(eof["eof"]).first()[0]
        else:
            kind = F.when(F.col(EOF_COL), None).when(F.col(DEAD_COL).isNotNull(), DEAD).otherwise(CLEAN).alias(KIND)
            seen_eof = table.commit(name, batch.select(*plain, EOF_COL, f"{DEAD_COL}.*", kind), eof, (EOF_COL,))["eof"]  # noticed by the write itself
        # Only after this batch's rows are committed: the driver then stops the
        # query once the trigger is idle (offsets committed).
        if seen_eof:
            flag.event.set()

    w = cleaned.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
    return w.start(), flag


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the query keeps in its checkpoint over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def run_until_eof(query: StreamingQuery, flag: _StopFlag, poll_seconds: float = 2.0,
                  timeout_seconds: float | None = None) -> None:
    """Wait while polling; stop after the batch that held the sentinel
    (or when an ``availableNow`` query finishes by itself)."""
    waited = 0.0
    while query.isActive:
        if flag.event.is_set() and not query.status.get("isTriggerActive", False):
            query.stop()
            break
        query.awaitTermination(poll_seconds)
        waited += poll_seconds
        if timeout_seconds is not None and waited >= timeout_seconds:
            query.stop()
            break
    if query.exception():
        raise query.exception()


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The clean rows of all committed batches."""
    return CommittedTable(spark, sink).read(CLEAN)


def dead_letters(spark: SparkSession, sink: str) -> DataFrame:
    """(value, error, origin) of the messages that could not be decoded."""
    return CommittedTable(spark, sink).read(DEAD)


def load_batch_then_stream(spark: SparkSession, model: LoanPrepModel, batch_df: DataFrame,
                           messages: DataFrame, schema: T.StructType, sink: str, checkpoint: str,
                           trigger: dict | None = None) -> DataFrame:
    """Commit the batch-cleaned table (again: replaced), then stream new records into it."""
    table = CommittedTable(spark, sink)
    table.commit("batch-load", model.transform(batch_df).withColumn(KIND, F.lit(CLEAN)))
    q, flag = clean_stream(spark, model, messages, schema, sink, checkpoint, trigger)
    run_until_eof(q, flag)
    return read_sink(spark, sink)
