"""Source, sink and streaming queries (SRC2-SRC15, SNK6-SNK7, ST1-ST4).

These queries first land data that Spark derives from the driver tables
(payload documents, a report CSV, an event log) in a fresh folder under the
shared checkpoint directory, then read it back through the source operators.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import curate as cur
from tidemark.operators import marts
from tidemark.plans import fixtures as fx
from tidemark.plans.catalog import CUR_ALL_SQL, curated_all
from tidemark.functions.values import exact_sum
from tidemark.plans.registry import r2, register, xsum
from tidemark.schema import SOURCES
from tidemark.session import shared_path
from tidemark.sinks import warehouse as wh
from tidemark.sources import csv_report as csvr
from tidemark.sources import json_scan
from tidemark.sources import payload as pl
from tidemark.sources.tables import table
from tidemark.streaming import events as ev

PAGE = 100
CART_ITEM = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("userId", T.LongType()),
    T.StructField("total", T.DoubleType()), T.StructField("totalProducts", T.LongType()),
])
CART_PAYLOAD = T.StructType([
    T.StructField("carts", T.ArrayType(CART_ITEM)), T.StructField("total", T.LongType()),
    T.StructField("skip", T.LongType()), T.StructField("limit", T.LongType()),
])


def land_cart_payloads(spark, sf_dir) -> str:
    """orders → one ``{"carts": [...], "total", "skip", "limit"}`` document per
    page of 100 order keys, written as JSON Lines (one payload per line).

    A page holds at most 100 records, so ``collect_list`` per page is bounded.
    """
    carts = fx.carts_raw(spark, sf_dir).drop("order_date")
    page = F.floor(F.col("id") / PAGE).cast("bigint")
    docs = carts.groupBy(page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("id", "userId", "total", "totalProducts"))).alias("carts"),
        F.count(F.lit(1)).alias("total"))
    text = docs.select(F.to_json(F.struct("carts", "total", (F.col("page") * PAGE).alias("skip"),
                                          F.lit(PAGE).cast("bigint").alias("limit"))).alias("value"))
    path = shared_path(spark, "landing", "carts")
    text.write.mode("overwrite").text(path)
    return path


UNWRAP_SQL = f"""
SELECT (id // {PAGE}) * {PAGE} AS skip,
       row_number() OVER (PARTITION BY id // {PAGE} ORDER BY id) - 1 AS _pos,
       id, userId, total, totalProducts
FROM ({fx.CARTS_SQL}) c"""


@register("json_unwrap", UNWRAP_SQL)
def q_json_unwrap(spark, sf_dir):
    """SRC2/SRC3/SRC10: payload lines → records with payload id and position."""
    payloads = pl.read_payloads(spark, land_cart_payloads(spark, sf_dir), schema=CART_PAYLOAD)
    return pl.unwrap(payloads, "carts", payload_id="skip")


DOCUMENT_ROWS = 4_000
NOTE_SQL = "CAST(id AS VARCHAR) || '\"}, {\"id\": [' || repeat('}\\\\', CAST(id % 5 AS INT)) || chr(10) || ']'"


@register("json_large_document", f"""
SELECT row_number() OVER (ORDER BY id) AS _row_number, id, userId, total, {NOTE_SQL} AS note,
       CASE WHEN id % 4000 = 0 THEN 30000 ELSE id % 3 END AS tags
FROM ({fx.CARTS_SQL}) c""")
def q_json_large_document(spark, sf_dir):
    """SRC2 + SRC3: documents of thousands of records each, with brackets, quotes and backslashes in their strings and a few records
    longer than a range, found by many tasks (ranges of 128 KB here)."""
    note = F.concat(F.col("id").cast("string"), F.lit('"}, {"id": ['), F.repeat(F.lit("}\\\\"), (F.col("id") % 5).cast("int")), F.lit("\n]"))
    tags = F.array_repeat(F.struct(F.lit("}").alias("t")), F.when(F.col("id") % 4000 == 0, 30000).otherwise(F.col("id") % 3).cast("int"))
    carts = fx.carts_raw(spark, sf_dir).select("id", "userId", "total", F.lpad(F.floor(F.col("id") / DOCUMENT_ROWS).cast("string"), 9, "0").alias("page"))
    # The short rows are shuffled, and texts made of them where they are written; a page holds at most DOCUMENT_ROWS of them.
    in_page = Window.partitionBy("page").orderBy("id")
    placed = carts.withColumns({"first": F.lag("id").over(in_page).isNull(), "last": F.lead("id").over(in_page).isNull()})
    text = F.concat(F.when(F.col("first"), F.lit('{"carts_of": {"carts": [{}]}, "carts": [\n')).otherwise(F.lit(",")), F.lit("\n  "),
                    F.to_json(F.struct(F.col("id"), "userId", "total", note.alias("note"), tags.alias("tags"))),
                    F.when(F.col("last"), F.lit('\n], "limit": [{"x": 1}]}')).otherwise(F.lit("")))
    path = shared_path(spark, "landing", "documents")
    placed.select("page", text.alias("value")).write.partitionBy("page").text(path)
    records = json_scan.read_records(spark, path, "carts", range_bytes=131_072).drop("_file")
    parsed = pl.parse_records(records, T.StructType.fromDDL("id bigint, userId bigint, total double, note string, tags array<struct<t: string>>"))
    return parsed.withColumn("tags", F.size("tags").cast("bigint"))


@register("json_payload_curate", f"""
SELECT 'carts_' || CAST(id AS VARCHAR) AS dw_id, 'run-payload' AS run_id, 'Planshet Survey' AS source_system,
       'carts' AS source_entity, 'api' AS ingestion_mode, {fx.PART_LOADED_AT_SQL} AS loaded_at,
       'Cart ' || CAST(id AS VARCHAR) AS entity_name, 'user_' || CAST(userId AS VARCHAR) AS category,
       'total' AS metric_name, COALESCE(NULLIF(total, 0), 0.0) AS metric_value,
       CAST(COALESCE(NULLIF(totalProducts, 0), 0) AS VARCHAR) || ' products' AS status
FROM ({fx.CARTS_SQL}) c""")
def q_json_payload_curate(spark, sf_dir):
    """SRC2 → SRC3 → PRJ5: landed cart payloads curated end to end."""
    payloads = pl.read_payloads(spark, land_cart_payloads(spark, sf_dir), schema=CART_PAYLOAD)
    s = SOURCES["carts"]
    return cur.curate(pl.unwrap(payloads, s.collection), source_id=s.source_id, source_title=s.title,
                      mode="api", run_id="run-payload", loaded_at=fx.PART_LOADED_AT)


@register("payload_summary", f"""
WITH c AS ({UNWRAP_SQL})
SELECT skip, 'object' AS kind, 'carts,total,skip,limit' AS top_level_keys, count(*) AS records,
       string_agg(CASE WHEN _pos < 3 THEN CAST(id AS VARCHAR) END, ',' ORDER BY _pos) AS sample_ids
FROM c GROUP BY skip""")
def q_payload_summary(spark, sf_dir):
    """SRC13/SRC14: per payload kind, keys, record count and a 3-record sample."""
    text = pl.read_payload_text(spark, land_cart_payloads(spark, sf_dir))
    s = pl.payload_summary(text, "carts")
    return s.select(F.get_json_object("value", "$.skip").cast("bigint").alias("skip"), "kind", "top_level_keys",
                    F.col("records").cast("bigint").alias("records"),
                    F.array_join(F.transform("sample", lambda x: F.get_json_object(x, "$.id")), ",")
                    .alias("sample_ids"))


@register("json_path", f"""
SELECT (id // {PAGE}) * {PAGE} AS skip, count(*) AS total FROM ({fx.CARTS_SQL}) c GROUP BY id // {PAGE}""")
def q_json_path(spark, sf_dir):
    """SRC12: ``$.total`` of every payload as an attribute."""
    text = pl.read_payload_text(spark, land_cart_payloads(spark, sf_dir))
    out = pl.json_path(pl.json_path(text, "$.skip", "skip"), "$.total", "total")
    return out.select(F.col("skip").cast("bigint").alias("skip"), F.col("total").cast("bigint").alias("total"))


# --- report CSV ----------------------------------------------------------------------
def land_report_csv(spark, sf_dir) -> str:
    """part → a ``;`` report CSV in key order: identifiers, a decimal-comma
    column, a mixed text/number column, blanks (see REPORT_SQL)."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    rows = p.orderBy("p_partkey").select(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("inn"),
        F.when(size % 9 == 0, F.lit("")).otherwise((size * 1000).cast("string")).alias("soato"),
        F.col("p_type").alias("section"), F.col("p_brand").alias("status"),
        size.cast("string").alias("g1"),
        F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("g2"),
        F.col("p_name").alias("g3"),
        F.when(size == 1, F.lit("n/a")).otherwise((size * 3).cast("string")).alias("g4"),
        F.when(size % 4 == 0, F.lit("   ")).otherwise(F.concat(size.cast("string"), F.lit(".5"))).alias("g5"))
    path = shared_path(spark, "landing", "report_csv")
    rows.write.option("sep", ";").option("header", True).csv(path)
    return path


REPORT_COLUMNS = ["inn", "soato", "section", "status", "g1", "g2", "g3", "g4", "g5"]
REPORT_SQL = """
SELECT row_number() OVER (ORDER BY p_partkey) AS _row_number,
       lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS inn,
       CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size * 1000 AS VARCHAR) END AS soato,
       p_type AS section, p_brand AS status, CAST(p_size AS BIGINT) AS g1, p_retailprice AS g2, p_name AS g3,
       CASE WHEN p_size = 1 THEN 'n/a' ELSE CAST(p_size * 3 AS VARCHAR) END AS g4,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size + 0.5 END AS g5,
       lpad(CAST(p_partkey AS VARCHAR), 9, '0') || ':' || CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR)
           AS id
FROM part"""


@register("csv_typing", REPORT_SQL)
def q_csv_typing(spark, sf_dir):
    """SRC4/SRC6/SRC9 + WIN1: scan, stored row number, per-column types, ids."""
    return csvr.load_report(spark, land_report_csv(spark, sf_dir))


@register("csv_page", f"SELECT * FROM ({REPORT_SQL}) r WHERE _row_number > 40 AND _row_number <= 65")
def q_csv_page(spark, sf_dir):
    """SRC5: the page skip=40, limit=25 (a range on the stored row number)."""
    return csvr.report_page(csvr.load_report(spark, land_report_csv(spark, sf_dir)), skip=40, limit=25)


@register("page_stats", f"""
SELECT CAST(floor((_row_number - 1) / 20) AS BIGINT) AS page, count(*) AS rows,
       sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in REPORT_COLUMNS)}) AS null_cells,
       count(DISTINCT NULLIF(inn, '')) AS organizations, 9 AS column_count
FROM ({REPORT_SQL}) r GROUP BY CAST(floor((_row_number - 1) / 20) AS BIGINT)""")
def q_page_stats(spark, sf_dir):
    """SRC7/SRC8: rows, NULL cells, organisations and width of every 20-row page."""
    return csvr.page_stats(csvr.load_report(spark, land_report_csv(spark, sf_dir)), REPORT_COLUMNS, 20)


# --- event envelope and stream --------------------------------------------------------------
POST_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("userId", T.LongType()),
])


def _post_events(spark, sf_dir):
    posts = fx.posts_raw(spark, sf_dir)
    run = F.when(F.col("userId") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("run_id"))
    return ev.envelope(posts.select("id", "title", "userId", (F.col("id") * 7).alias("extra"), run.alias("_run"), "loaded_at"),
                       run_id=F.col("_run"), source="posts", event_time=F.col("loaded_at"), drop=("_run", "loaded_at"))


ENVELOPE_SQL = f"""
SELECT CAST(id AS VARCHAR) AS key, CASE WHEN userId % 10 = 0 THEN NULL ELSE run_id END AS run_id,
       'posts' AS source, CAST(loaded_at AS VARCHAR) AS event_time, id AS payload_id, title AS payload_title
FROM ({fx.POSTS_SQL}) p"""


@register("event_envelope", ENVELOPE_SQL)
def q_event_envelope(spark, sf_dir):
    """ST2: row envelopes keyed by record id, parsed back from their JSON value."""
    e = _post_events(spark, sf_dir)
    parsed = F.from_json("value", ev.envelope_schema(POST_PAYLOAD))
    return e.select("key", parsed.alias("e")).select(
        "key", "e.run_id", "e.source", "e.event_time", F.col("e.payload.id").alias("payload_id"),
        F.col("e.payload.title").alias("payload_title"))


@register("stream_route", f"""
SELECT key, COALESCE(run_id, 'no_run') AS run_id, source, event_time, payload_id, payload_title,
       payload_id * 7 AS extra, CAST(NULL AS VARCHAR) AS broken
FROM ({ENVELOPE_SQL}) e
UNION ALL
SELECT key, 'no_run', '_malformed', NULL, NULL, NULL, NULL, '{{"payload": ' || key FROM ({ENVELOPE_SQL}) e WHERE payload_id % 10 = 0""")
def q_stream_route(spark, sf_dir):
    """ST1 + ST4: envelopes through the file event log and the routed raw sink
    (availableNow trigger, checkpointed), read back as a table."""
    log = shared_path(spark, "events", "log")
    out = shared_path(spark, "events", "raw")
    ckpt = shared_path(spark, "events", "checkpoint")
    events = _post_events(spark, sf_dir)
    broken = events.where(F.get_json_object("value", "$.payload.id").cast("bigint") % 10 == 0).select(
        "key", F.concat(F.lit('{"payload": '), "key").alias("value"))
    ev.publish(events.unionByName(broken), log)
    q = ev.route_to_raw(ev.event_stream(spark, log), out, ckpt)
    q.awaitTermination()
    back = ev.read_raw_events(spark, out, POST_PAYLOAD)
    return back.select("key", "run_id", "source", "event_time", F.col("payload.id").alias("payload_id"),
                       F.col("payload.title").alias("payload_title"),
                       F.get_json_object("value", "$.payload.extra").cast("bigint").alias("extra"),  # a field no schema declares
                       F.when(F.col("source") == ev.MALFORMED, F.col("value")).alias("broken"))


@register("warehouse_roundtrip", f"""
SELECT source_entity, count(*) AS rows, round({xsum('metric_value')}, 2) AS metric_sum,
       count(DISTINCT run_id) AS runs
FROM ({CUR_ALL_SQL}) c GROUP BY source_entity""")
def q_warehouse_roundtrip(spark, sf_dir):
    """SNK6/SNK7/SRC15: append every curated set to a fresh warehouse table,
    read it back by path and roll it up per source entity."""
    root = shared_path(spark, "warehouse")
    wh.append_curated(curated_all(spark, sf_dir), root)
    back = wh.read_curated(spark, root)
    return back.groupBy("source_entity").agg(
        F.count(F.lit(1)).alias("rows"), r2(exact_sum("metric_value")).alias("metric_sum"),
        F.count_distinct("run_id").alias("runs"))


@register("staging_view", f"SELECT * FROM ({CUR_ALL_SQL}) c")
def q_staging_view(spark, sf_dir):
    """PRJ11 + SNK11: the staging projection as a view, queried with SQL."""
    wh.register_view(marts.staging_view(curated_all(spark, sf_dir)), "stg_curated_events")
    return spark.sql("SELECT * FROM stg_curated_events")


@register("csv_total", "SELECT count(*) AS total FROM part")
def q_csv_total(spark, sf_dir):
    """SRC7: data rows of the report CSV, header excluded."""
    return csvr.total_rows(csvr.read_report_csv(spark, land_report_csv(spark, sf_dir)))


@register("payload_counts", f"""
SELECT (id // {PAGE}) * {PAGE} AS skip, count(*) AS records FROM ({fx.CARTS_SQL}) c GROUP BY id // {PAGE}""")
def q_payload_counts(spark, sf_dir):
    """SRC13: records per landed payload (0 when the collection key is missing)."""
    text = pl.read_payload_text(spark, land_cart_payloads(spark, sf_dir))
    return pl.payload_count(text, "carts").select(F.get_json_object("value", "$.skip").cast("bigint").alias("skip"),
                                                  F.col("records").cast("bigint").alias("records"))
