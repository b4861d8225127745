"""Queries over whole runs and over hostile inputs of the sources (AUD1, AUD2, AUD4, SRC3, SRC6, SRC10, SNK1-SNK10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import audit, lineage, marts
from tidemark.plans import fixtures as fx
from tidemark.plans import runner
from tidemark.plans.catalog import CUR_ALL_SQL, curated_all
from tidemark.plans.q_sources import PAGE, land_report_csv
from tidemark.plans.registry import register, xsum
from tidemark.plans.run_log import CHAIN, COUNTED, block_event_log
from tidemark.schema import RunRequest, sources_frame, SOURCES
from tidemark.session import shared_path
from tidemark.sinks import warehouse as wh
from tidemark.sinks.landing import read_manifest, verify_landing
from tidemark.sources import csv_report as csvr
from tidemark.sources import payload as pl
from tidemark.sources.tables import table

def _expected(name: str, stages, status: dict[str, str]) -> str:
    return ", ".join(f"('{name}', {k + 1}, '{s}', '{status.get(s, 'done')}', {int(s in COUNTED and status.get(s, 'done') == 'done')})" for k, s in enumerate(stages))


@register("run_stage_log", f"""
WITH e(run_name, sequence, id, status, counted) AS (VALUES
  {_expected("whole", CHAIN, {})},
  {_expected("stopped", CHAIN[:6] + CHAIN[-1:], {"gx": "error"})},
  {_expected("warned", CHAIN, {"kafka": "warning"})},
  {_expected("strict", CHAIN[:2] + CHAIN[-1:], {"kafka": "error"})})
SELECT run_name, sequence, id, status, counted * (SELECT count(*) FROM part) AS records,
       CASE run_name WHEN 'whole' THEN 'done' WHEN 'warned' THEN 'warning' ELSE 'error' END AS audited_status
FROM e""")
def q_run_stage_log(spark, sf_dir):
    """AUD1 + AUD2 + AUD4: the runner's own stage log over the whole report, one good run, one
    controlled failure, and a real failure of the event log in a normal and in a strict run."""
    path = land_report_csv(spark, sf_dir)
    logs, audits = [], []
    for name, request, broken in (("whole", RunRequest(), False), ("stopped", RunRequest(failure_stage="gx"), False),
                                  ("warned", RunRequest(), True), ("strict", RunRequest(strict=True), True)):
        root = shared_path(spark, "runs", name)
        if broken:
            block_event_log(spark, root)
        result = runner.run(spark, request, input_path=path, root=root)
        logs.append(result.stages.withColumn("run_name", F.lit(name)))
        audits.append(wh.read_runs(spark, root).select("run_id", F.col("status").alias("audited_status")))
    stages, runs = logs[0], audits[0]
    for more, other in zip(logs[1:], audits[1:]):
        stages, runs = stages.unionByName(more), runs.unionByName(other)
    return stages.join(runs, "run_id").select("run_name", F.col("sequence").cast("bigint").alias("sequence"), "id", "status",
                                              audit.stage_record_count(stages).alias("records"), "audited_status")


@register("run_full_report", """
SELECT 'raw' AS zone, count(*) AS rows FROM part UNION ALL SELECT 'prepared', count(*) FROM part
UNION ALL SELECT 'curated', count(*) FROM part UNION ALL SELECT 'warehouse', count(*) FROM part
UNION ALL SELECT 'lineage', count(*) FROM part UNION ALL SELECT 'report', 4""")
def q_run_full_report(spark, sf_dir):
    """SNK1-SNK6, SNK10: a run takes the whole report, in every zone, with its quality report written."""
    root = shared_path(spark, "runs", "report")
    result = runner.run(spark, RunRequest(), input_path=land_report_csv(spark, sf_dir), root=root)
    report = wh.write_report(result.quality_checks, f"{root}/reports/{result.run_id}")
    frames = {"raw": wh.read_zone(spark, root, "raw", "products", result.run_id), "prepared": result.prepared, "curated": result.curated,
              "warehouse": wh.read_curated(spark, root), "lineage": result.lineage,
              "report": spark.read.schema("name string, passed boolean, value string").json(report)}
    out = None
    for zone, rows in frames.items():
        one = rows.agg(F.lit(zone).alias("zone"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


@register("json_mixed_payloads", f"""
SELECT id, userId, total, totalProducts, (id // {PAGE}) % 2 = 0 AS from_array FROM ({fx.CARTS_SQL}) c
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL WHERE false""")
def q_json_mixed_payloads(spark, sf_dir):
    """SRC3 + SRC10: arrays and objects mixed in one input, with a blank first line and broken
    lines; each payload is decided on its own and no record is lost."""
    carts = fx.carts_raw(spark, sf_dir).drop("order_date")
    page = F.floor(F.col("id") / PAGE).cast("bigint")
    docs = carts.groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("id", "userId", "total", "totalProducts"))).alias("carts"))
    array = F.col("page") % 2 == 0
    text = docs.select(F.when(array, F.to_json("carts")).otherwise(F.to_json(F.struct("carts", "page"))).alias("value"))
    noise = docs.where(F.col("page") % 7 == 0).select(F.explode(F.array(F.lit(""), F.lit("{\"carts\": 3}"), F.lit("[1, 2"), F.lit("{\"other\": []}"))).alias("value"))
    path = shared_path(spark, "landing", "mixed")
    noise.unionByName(text).write.text(path)
    landed = pl.read_payload_text(spark, path).withColumn("from_array", F.ltrim("value").startswith("["))
    return pl.parse_records(pl.unwrap_text(landed, "carts", keep=("from_array",))).select("id", "userId", "total", "totalProducts", "from_array")


@register("csv_long_digits", """
SELECT CAST(p_partkey AS VARCHAR) || '90071992547409930007' AS digits,
       CASE WHEN p_size = 1 THEN '12345678901234567890' ELSE CAST(9007199254740992 + p_size AS VARCHAR) END AS mixed,
       9007199254740992 + p_size AS big, CASE WHEN p_size = 1 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS g4, p_size + 0.5 AS "odd.name's",
       CASE WHEN p_size = 1 THEN 'g5' ELSE 'g4' END AS metric_name, CASE WHEN p_size = 1 THEN 1.5 ELSE CAST(p_size AS DOUBLE) END AS metric_value
FROM part""")
def q_csv_long_digits(spark, sf_dir):
    """SRC6 + PRJ7: integers beyond 64 bits keep every digit as text, 64-bit ones stay exact, one bad cell
    does not take a column from the other rows, and headers may hold dots and apostrophes."""
    from tidemark.operators.curate import first_numeric_metric

    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    big = (F.lit(9007199254740992) + size).cast("string")
    rows = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit("90071992547409930007")).alias("digits"),
                    F.when(size == 1, F.lit("12345678901234567890")).otherwise(big).alias("mixed"), big.alias("big"),
                    F.when(size == 1, F.lit("n/a")).otherwise(size.cast("string")).alias("g4"),
                    F.concat(size.cast("string"), F.lit(",5")).alias("odd.name's"), F.concat(size.cast("string"), F.lit(",5")).alias("g5"))
    path = shared_path(spark, "landing", "digits")
    rows.write.option("sep", ";").option("header", True).csv(path)
    typed = csvr.load_report(spark, path)
    metric = first_numeric_metric(typed)
    return typed.select("digits", "mixed", "big", "g4", "`odd.name's`", metric["metric_name"].alias("metric_name"), metric["metric_value"].alias("metric_value"))


LANDED_LINE_SQL = "CAST(o_orderkey AS VARCHAR) || ';' || o_orderpriority || ';' || chr(233) || o_orderstatus"


@register("landing_manifest", f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 1 AS files, CAST(sum(strlen({LANDED_LINE_SQL}) + 2) AS BIGINT) AS bytes, true AS intact
FROM orders GROUP BY 1""")
def q_landing_manifest(spark, sf_dir):
    """SNK1 + SNK13: a file per order month is landed by tasks; the manifest and the landed bytes agree."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority", F.concat(F.lit("\u00e9"), "o_orderstatus"))
    path, root = shared_path(spark, "landing", "orders"), shared_path(spark, "runs", "landed")
    (o.select(F.trunc("o_orderdate", "MM").alias("month"), F.concat(line, F.lit("\r")).alias("value")).repartition("month").sortWithinPartitions("month")
     .write.partitionBy("month").text(path))
    target = wh.write_landing(spark, path, root, "orders", "r")
    sources = read_manifest(spark, target).select("number", F.regexp_extract("source", r"month=([0-9-]+)/", 1).cast("date").alias("month"))
    return verify_landing(spark, target).join(sources, "number", "left").groupBy("month").agg(
        F.count("*").cast("int").alias("files"), F.sum("bytes").alias("bytes"), F.bool_and("intact").alias("intact"))


BREAK_LINES = 600


@register("csv_quoted_breaks", f"""
SELECT row_number() OVER (ORDER BY p_partkey) AS _row_number, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS inn, CAST(p_size AS BIGINT) AS g1,
       CASE WHEN p_partkey % 50 = 0 THEN repeat('line ;"' || p_brand || '"' || chr(10), {BREAK_LINES}) || 'end'
            WHEN p_size % 3 = 0 THEN p_name || ';' || chr(13) || chr(10) || '"' || p_type || '"' WHEN p_size % 3 = 1 THEN p_name
            ELSE p_name || chr(10) || chr(10) || ';' END AS remark,
       p_size + 0.5 AS g2, lpad(CAST(p_partkey AS VARCHAR), 9, '0') || ':' || CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR) AS id
FROM part""")
def q_csv_quoted_breaks(spark, sf_dir):
    """SRC4: line breaks inside quoted cells, some cells longer than an input split, read by many tasks
    (splits of 16 KB here) with ordinals, types and ids."""
    p, size, name = table(spark, sf_dir, "part"), F.col("p_size"), F.col("p_name")
    line = F.concat(F.lit('line ;"'), F.col("p_brand"), F.lit('"\n'))
    remark = (F.when(F.col("p_partkey") % 50 == 0, F.concat(F.repeat(line, F.lit(BREAK_LINES)), F.lit("end")))
              .when(size % 3 == 0, F.concat(name, F.lit(';\r\n"'), F.col("p_type"), F.lit('"'))).when(size % 3 == 1, name)
              .otherwise(F.concat(F.lit("\n"), name, F.lit("\n\n;"))))
    rows = p.repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey").select(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("inn"), size.cast("string").alias("g1"), remark.alias("remark"),
        F.concat(size.cast("string"), F.lit(",5")).alias("g2"))
    path = shared_path(spark, "landing", "breaks")
    (rows.write.option("sep", ";").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return csvr.load_report(spark, path, split_bytes=16_384)


@register("source_registry", f"""
SELECT s.source_id, s.title, s.collection, count(c.source_entity) AS curated_rows
FROM (VALUES {", ".join(f"('{s.source_id}', '{s.title}', '{s.collection}')" for s in SOURCES.values())}) s(source_id, title, collection)
LEFT JOIN ({CUR_ALL_SQL}) c ON c.source_entity = s.source_id GROUP BY ALL""")
def q_source_registry(spark, sf_dir):
    """SRC1: the registered sources with their curated rows."""
    rows = marts.entity_counts(curated_all(spark, sf_dir)).withColumnRenamed("rows", "n")
    return sources_frame(spark).join(rows, F.col("source_id") == F.col("source_entity"), "left").select(
        "source_id", "title", "collection", F.coalesce("n", F.lit(0)).alias("curated_rows"))


@register("mart_table", f"""
SELECT source_entity, load_date, sum(record_count) AS records FROM (
SELECT source_entity, category, metric_name, CAST(loaded_at AS DATE) AS load_date, count(*) AS record_count
FROM ({CUR_ALL_SQL}) c GROUP BY ALL) m GROUP BY ALL""")
def q_mart_table(spark, sf_dir):
    """SNK7 + SNK12: curated rows appended and compacted, the table registered, the mart rebuilt and read back."""
    root = shared_path(spark, "warehouse")
    wh.append_curated(curated_all(spark, sf_dir), root)
    wh.compact_curated(spark, root, "posts")
    name = "curated_" + root.rsplit("/", 1)[1]
    wh.create_curated_table(spark, root, name)
    mart = spark.read.parquet(wh.write_mart(marts.daily_metrics(spark.table(name)), root))
    return mart.groupBy("source_entity", "load_date").agg(F.sum("record_count").alias("records"))


@register("version_export", f"""
SELECT dw_id, metric_value, (SELECT count(*) FROM ({CUR_ALL_SQL}) c WHERE source_entity = 'users') AS record_count
FROM ({CUR_ALL_SQL}) c WHERE source_entity = 'users'""")
def q_version_export(spark, sf_dir):
    """SNK14: a version exported as JSON Lines with its manifest, read back."""
    rows = curated_all(spark, sf_dir).where(F.col("source_entity") == "users")
    path = wh.export_version(rows, shared_path(spark, "exports"), {"version": "prep:users:v1"})
    count = spark.read.text(f"{path}/manifest").select(F.get_json_object("value", "$.record_count").cast("bigint").alias("record_count")).scalar()
    return spark.read.schema("dw_id string, metric_value double").json(f"{path}/data").withColumn("record_count", count)


@register("repeated_edits", f"""
SELECT id, CASE WHEN id IS NULL THEN 'none' ELSE 'given' END AS label, field, before, after,
       CASE WHEN before IS NOT DISTINCT FROM after THEN 'same' ELSE 'changed' END AS state
FROM (SELECT CASE WHEN id % 3 = 0 THEN NULL ELSE id // 5 END AS id, 'total' AS field, CAST(total AS VARCHAR) AS before,
             CAST(CASE WHEN id % 2 = 0 THEN total + 1 ELSE total END AS VARCHAR) AS after FROM ({fx.CARTS_SQL}) c) t""")
def q_repeated_edits(spark, sf_dir):
    """DIF1 over repeated and NULL ids: rows meet on the stored ordinal, one row out for each row in."""
    rows = fx.carts_raw(spark, sf_dir).select(F.col("id").alias("_row"), F.when(F.col("id") % 3 != 0, F.floor(F.col("id") / 5).cast("bigint")).alias("id"), "total")
    edited = rows.withColumn("total", F.when(F.col("_row") % 2 == 0, F.col("total") + 1).otherwise(F.col("total")))
    diff = lineage.field_diff(rows, edited, ordinal="_row")
    return diff.select("id", F.when(F.col("id").isNull(), "none").otherwise("given").alias("label"), "field", "before", "after", "state")
