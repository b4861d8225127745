import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming import events as ev

PAYLOAD = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def test_stream_route_defaults_and_restart_adds_none(spark, scratch):
    log, out, ckpt = (os.path.join(scratch, n) for n in ("log", "out", "ckpt"))
    rows = spark.createDataFrame([(1, "a", "r1"), (2, "b", None), (None, "c", "r2")], "id long, v string, run string")
    ev.publish(ev.envelope(rows.select("id", "v", "run"), run_id=F.col("run"), source="posts",
                           event_time="2024-01-01T00:00:00"), log)
    ev.route_to_raw(ev.event_stream(spark, log), out, ckpt).awaitTermination()
    back = ev.read_raw_events(spark, out, PAYLOAD)
    got = sorted((r["key"], r["run_id"], r["source"]) for r in back.collect())
    assert got == [("1", "r1", "posts"), ("2", "no_run", "posts"), ("r2", "r2", "posts")]
    # Same checkpoint, no new files: the restart writes nothing new.
    ev.route_to_raw(ev.event_stream(spark, log), out, ckpt).awaitTermination()
    assert ev.read_raw_events(spark, out, PAYLOAD).count() == 3
    # New events are picked up exactly once.
    ev.publish(ev.run_event(spark, run_id="r3", source="users", mode="batch", records=9), log)
    ev.route_to_raw(ev.event_stream(spark, log), out, ckpt).awaitTermination()
    assert ev.read_raw_events(spark, out, PAYLOAD).count() == 4


def test_stream_equals_batch(spark, scratch):
    log, out, ckpt = (os.path.join(scratch, n) for n in ("log", "out", "ckpt"))
    rows = spark.range(50).select(F.col("id"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    env = ev.envelope(rows, run_id="r", source="s", event_time="t")
    ev.publish(env, log)
    ev.route_to_raw(ev.event_stream(spark, log, max_files_per_trigger=1), out, ckpt).awaitTermination()
    streamed = sorted(r["key"] for r in ev.read_raw_events(spark, out, PAYLOAD).collect())
    assert streamed == sorted(r["key"] for r in env.collect())


def test_route_keeps_whole_events_and_malformed_text(spark, scratch):
    log, out, ckpt = (os.path.join(scratch, n) for n in ("log", "out", "ckpt"))
    values = ['{"run_id":"r","source":"s","payload":{"id":1,"extra":[1,2]},"more":true}', '{"payload": 1', "", "[1]", '{"payload":{}}']
    ev.publish(spark.createDataFrame([(str(k), v) for k, v in enumerate(values)], "key string, value string"), log)
    ev.route_to_raw(ev.event_stream(spark, log), out, ckpt).awaitTermination()
    got = {r["key"]: (r["source"], r["run_id"], r["value"]) for r in ev.read_raw_events(spark, out, PAYLOAD).collect()}
    assert got == {"0": ("s", "r", values[0]), "1": (ev.MALFORMED, "no_run", values[1]), "2": (ev.MALFORMED, "no_run", ""),
                   "3": (ev.MALFORMED, "no_run", "[1]"), "4": ("unknown", "no_run", values[4])}
