"""Event envelopes, the event log and the routed raw sink (ST1-ST4, SNK9, SNK15).

The broker connector is not on this classpath, so the event log is a folder of
JSON Lines files in the shared file system: ``publish`` appends envelopes
(batch), ``event_stream`` reads them with the file source (a declared schema,
new files picked up per micro-batch) and ``route_to_raw`` writes them to
``source=…/run_id=…`` folders, whole: an event's text is stored as it came, so
fields that no schema declares stay, and text that is no JSON object goes to
``source=_malformed``.  The checkpoint makes the sink exactly-once:
a restart replays nothing that was committed.  With the Kafka connector on the
classpath, ``event_stream(..., kafka=…)`` reads the topic instead and the rest
is unchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Defaults the consumer uses when an event lacks them.
UNKNOWN_SOURCE = "unknown"
NO_RUN = "no_run"
# Routing name for text that is not a JSON object.
MALFORMED = "_malformed"

RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("records", T.LongType()),
    T.StructField("created_at", T.StringType()),
])


def envelope(rows: DataFrame, *, run_id: str | Column, source: str | Column,
             event_time: str | Column, id_col: str = "id", drop: tuple[str, ...] = ()) -> DataFrame:
    """ST2: ``{run_id, source, event_time, payload}`` keyed by the record id,
    or by the run id when the record has none.  ``drop`` names columns that only
    carry the envelope's own fields and stay out of the payload."""
    rid = run_id if isinstance(run_id, Column) else F.lit(run_id)
    src = source if isinstance(source, Column) else F.lit(source)
    etime = event_time if isinstance(event_time, Column) else F.lit(event_time)
    payload_cols = [c for c in rows.columns if c not in drop]
    key = F.coalesce(F.col(id_col).cast("string"), rid) if id_col in rows.columns else rid
    return rows.select(
        key.alias("key"),
        F.to_json(F.struct(rid.alias("run_id"), src.alias("source"), etime.cast("string").alias("event_time"),
                           F.struct(*[F.col(c) for c in payload_cols]).alias("payload"))).alias("value"))


def run_event(spark: SparkSession, *, run_id: str, source: str, mode: str, records: int,
              created_at: dt.datetime | None = None) -> DataFrame:
    """ST3: the one-row run summary event, ready for the same sink."""
    created = (created_at or dt.datetime.now(dt.timezone.utc)).isoformat()
    row = spark.createDataFrame([(run_id, source, mode, int(records), created)], RUN_EVENT_SCHEMA)
    return row.select(F.col("run_id").alias("key"), F.to_json(F.struct(*row.columns)).alias("value"))


def publish(events: DataFrame, log_path: str) -> None:
    """SNK15: append ``(key, value)`` events to the event log folder."""
    events.select("key", "value").write.mode("append").json(log_path)


def envelope_schema(payload: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("payload", payload),
    ])


def event_stream(spark: SparkSession, log_path: str, *,
                 max_files_per_trigger: int | None = None, kafka: dict | None = None) -> DataFrame:
    """ST1: the event log as a stream of (key, value), earliest first; ``value`` is the event's whole text."""
    if kafka:
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for k, v in kafka.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
    else:
        reader = spark.readStream.schema("key string, value string")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.json(log_path)


def routed(events: DataFrame) -> DataFrame:
    """ST4 routing keys: missing source/run id get the consumer's defaults; text
    that is no JSON object is routed to the malformed side with its text."""
    whole = F.get_json_object("value", "$")
    is_event = F.coalesce(F.ltrim(whole).startswith("{"), F.lit(False))
    return events.withColumns({
        "source": F.when(is_event, F.coalesce(F.get_json_object("value", "$.source"), F.lit(UNKNOWN_SOURCE))).otherwise(F.lit(MALFORMED)),
        "run_id": F.when(is_event, F.coalesce(F.get_json_object("value", "$.run_id"), F.lit(NO_RUN))).otherwise(F.lit(NO_RUN)),
    })


def route_to_raw(events: DataFrame, out_path: str, checkpoint: str, *,
                 available_now: bool = True) -> StreamingQuery:
    """ST4 + SNK9: append events (key and whole text) to ``{out}/source=…/run_id=…`` as JSON Lines."""
    writer = (routed(events).writeStream.format("json").outputMode("append")
              .partitionBy("source", "run_id").option("checkpointLocation", checkpoint)
              .option("path", out_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_raw_events(spark: SparkSession, out_path: str, payload_schema: T.StructType) -> DataFrame:
    """The routed sink back as a batch table: key, value (the whole text), event_time,
    payload (the declared fields), source, run_id."""
    rows = spark.read.schema("key string, value string, source string, run_id string").json(out_path)
    parsed = F.from_json("value", envelope_schema(payload_schema))
    return rows.select("key", "value", parsed["event_time"].alias("event_time"), parsed["payload"].alias("payload"), "source", "run_id")
