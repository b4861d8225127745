"""Stage-log and run-audit queries (AUD1-AUD7, AGG15-AGG18, SNK8, FLT3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import audit, marts
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import register
from tidemark.plans.run_log import RUN_LOG_SQL, real_runs
from tidemark.sources.tables import table

LOG = f"({RUN_LOG_SQL})"
STAGES = f"({fx.STAGE_LOG_SQL})"
# Duration buckets (ms) of the run histogram query.
RUN_BUCKETS = [1000, 5000, 10000, 50000, 100000]
DISPLAY_SQL = "CASE WHEN id = 'raw' THEN 'landing' WHEN id = 'curated' THEN 'spark' ELSE id END"


@register("stage_log", f"""
SELECT run_id, source, mode, id, sequence, status, CASE status WHEN 'done' THEN 0 ELSE 1 END AS warnings, records AS record_count, true AS timed
FROM {LOG} s""")
def q_stage_log(spark, sf_dir):
    """AUD1 + AUD2 + AUD7: the stage log of real runs with record counts; every stage ends after it starts."""
    s = real_runs(spark, sf_dir)
    return s.select("run_id", "source", "mode", "id", "sequence", "status", F.size("warnings").alias("warnings"),
                    audit.stage_record_count(s).alias("record_count"),
                    ((F.col("ended_at") >= F.col("started_at")) & (F.col("duration_ms") >= 0)).alias("timed"))


@register("stage_chain", f"""
SELECT run_id, string_agg(id, ' -> ' ORDER BY sequence) AS chain
FROM (SELECT run_id, id, sequence FROM {STAGES} s UNION ALL SELECT run_id, id, sequence FROM {LOG} r) u GROUP BY run_id""")
def q_stage_chain(spark, sf_dir):
    """AUD5: stage chain text of each run per event type and day, and of each real run."""
    named = ("run_id", "id", "sequence")
    return audit.stage_chain(fx.stage_log(spark, sf_dir).select(*named).unionByName(real_runs(spark, sf_dir).select(*named)))


@register("run_status", f"""
SELECT run_id, CASE WHEN bool_or(status = 'error') THEN 'error' WHEN bool_or(status = 'warning') THEN 'warning' ELSE 'done' END AS status,
       max(CASE WHEN status = 'error' THEN id END) AS failed_stage, count(*) AS stages
FROM {LOG} s GROUP BY run_id""")
def q_run_status(spark, sf_dir):
    """AUD3: run status from the stages of real runs; a failed run stops at the failed stage."""
    return audit.run_status(real_runs(spark, sf_dir))


@register("stage_rollup", f"""
WITH s AS (SELECT *, {DISPLAY_SQL} AS display_stage FROM {LOG} s)
SELECT run_id, display_stage, CASE max(CASE status WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END)
            WHEN 2 THEN 'error' WHEN 1 THEN 'warning' ELSE 'done' END AS status,
       min(sequence) AS sequence, count(*) AS merged_stages, count_if(status <> 'done') AS warnings, max(records) AS records, true AS adds_up
FROM s GROUP BY run_id, display_stage""")
def q_stage_rollup(spark, sf_dir):
    """AGG18: landing+raw and transform+curated of real runs as one stage each; times and sizes add up to the log's, and
    the later stage's end is kept."""
    log = real_runs(spark, sf_dir)
    display = F.when(F.col("id") == "raw", "landing").when(F.col("id") == "curated", "spark").otherwise(F.col("id"))
    sums = log.groupBy("run_id", display.alias("display_stage")).agg(
        F.sum("duration_ms").alias("ms"), F.sum("data_size_bytes").alias("bytes"), F.max("ended_at").alias("last"))
    m = audit.merge_stage_pairs(log)
    adds_up = (F.col("duration_ms") == F.col("ms")) & (F.col("data_size_bytes") == F.col("bytes")) & (F.col("ended_at") == F.col("last"))
    return m.join(sums, ["run_id", "display_stage"]).select(
        "run_id", "display_stage", "status", "sequence", "merged_stages", F.size("warnings").alias("warnings"),
        audit.stage_record_count(m).alias("records"), adds_up.alias("adds_up"))


@register("run_report", f"""
WITH place(id, destination) AS (VALUES ('kafka', 'events/ingestion'), ('landing', 'landing'), ('raw', 'raw'), ('preparation', 'prepared'),
                                       ('curated', 'curated'), ('clickhouse', 'warehouse/curated_events'))
SELECT run_id, count(*) AS destinations, string_agg(destination, ', ' ORDER BY destination) AS destination_list, true AS adds_up
FROM (SELECT DISTINCT run_id, destination FROM {LOG} s JOIN place USING (id) WHERE status = 'done') d GROUP BY run_id""")
def q_run_report(spark, sf_dir):
    """AGG15 + FLT3 + SET3: stage time and distinct storage destinations of real runs (shown below their root; the
    audit row's own folder, written last, is left out of both)."""
    log = real_runs(spark, sf_dir).where("id <> 'postgres'")
    sums = log.groupBy("run_id").agg(F.sum("duration_ms").alias("ms"), F.min("root").alias("root"))
    report = audit.run_report(log).join(sums, "run_id")
    below = F.transform(F.split("destination_list", ", "), lambda d: F.regexp_replace(F.element_at(F.split(d, F.concat(F.col("root"), F.lit("/"))), -1),
                                                                                      "/(zone_)?source=.*", ""))
    return report.select("run_id", "destinations", F.array_join(F.array_sort(below), ", ").alias("destination_list"),
                         (F.col("stage_duration_ms") == F.col("ms")).alias("adds_up"))


@register("run_metrics", f"""
WITH r AS (SELECT run_id, source, mode, sum(duration_ms) AS duration_ms FROM {STAGES} s GROUP BY run_id, source, mode)
SELECT source, mode, count(*) AS runs, sum(duration_ms) AS duration_ms_sum,
       {", ".join(f"count_if(duration_ms <= {b}) AS le_{b}" for b in RUN_BUCKETS)},
       sum(duration_ms) > 0 AS timed, count_if(duration_ms <= 0) AS le_0, count_if(duration_ms <= 86400000) AS le_86400000
FROM r GROUP BY source, mode
UNION ALL
SELECT source, mode, count(DISTINCT run_id) AS runs, NULL AS duration_ms_sum, {", ".join(f"NULL AS le_{b}" for b in RUN_BUCKETS)},
       true AS timed, 0 AS le_0, count(DISTINCT run_id) AS le_86400000
FROM {LOG} s GROUP BY source, mode""")
def q_run_metrics(spark, sf_dir):
    """AGG16: counter and duration histogram per (source, mode) of the runs per event type and day, and of real runs.  A real
    run takes as long as the machine needs, so of its times only what always holds is shown: none takes no time, none a day."""
    shown = ["source", "mode", "runs", "duration_ms_sum", *[f"le_{b}" for b in RUN_BUCKETS], (F.col("duration_ms_sum") > 0).alias("timed"), "le_0", "le_86400000"]

    def metrics(stages):
        runs = stages.groupBy("run_id", "source", "mode").agg(F.sum("duration_ms").alias("duration_ms"))
        return audit.run_metrics(runs, [0, *RUN_BUCKETS, 86_400_000]).select(*shown)

    unsteady = {c: F.lit(None).cast("bigint") for c in ("duration_ms_sum", *[f"le_{b}" for b in RUN_BUCKETS])}
    return metrics(fx.stage_log(spark, sf_dir)).unionByName(metrics(real_runs(spark, sf_dir)).withColumns(unsteady))


def _audit_batches(spark, sf_dir):
    runs = fx.event_runs(spark, sf_dir)
    warn = F.col("total") > F.col("n") * 25
    existing = runs.where(F.dayofmonth("day") <= 20).select(
        "run_id", "source", "mode",
        F.when(warn, F.lit("warning")).otherwise(F.lit("done")).alias("status"),
        F.col("n").alias("records"),
        F.when(F.col("high") * 8 > F.col("n"), F.lit(75)).otherwise(F.lit(100)).alias("quality_score"),
        F.when(warn, F.array(F.lit("landing: local fallback"))).otherwise(F.array().cast("array<string>"))
        .alias("warnings"),
        F.col("start").cast("timestamp").alias("created_at"),
        (F.col("start") + F.expr("INTERVAL 1 HOUR")).cast("timestamp").alias("updated_at"))
    incoming = runs.where(F.dayofmonth("day") >= 15).select(
        "run_id", "source", "mode", F.lit("done").alias("status"),
        (F.col("n") + F.col("high")).alias("records"), F.lit(100).alias("quality_score"),
        F.array().cast("array<string>").alias("warnings"),
        (F.col("start") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("created_at"),
        (F.col("start") + F.expr("INTERVAL 2 DAYS")).cast("timestamp").alias("updated_at"))
    return existing, incoming


RUNS_SQL = """
SELECT event_type || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, event_type AS source,
       CASE WHEN event_type IN ('click', 'view') THEN 'stream' ELSE 'batch' END AS mode,
       CAST(ts AS DATE) AS day, count(*) AS n, sum(value) AS total, count_if(value > 45) AS high, min(ts) AS start
FROM events GROUP BY event_type, CAST(ts AS DATE)"""


UPSERT_SQL = f"""
WITH runs AS ({RUNS_SQL}),
e AS (SELECT run_id, source, mode, CASE WHEN total > n * 25 THEN 'warning' ELSE 'done' END AS status,
             n AS records, CASE WHEN high * 8 > n THEN 75 ELSE 100 END AS quality_score,
             CASE WHEN total > n * 25 THEN ['landing: local fallback'] ELSE []::VARCHAR[] END AS warnings,
             start AS created_at, start + INTERVAL 1 HOUR AS updated_at
      FROM runs WHERE day(day) <= 20),
i AS (SELECT run_id, source, mode, 'done' AS status, n + high AS records, 100 AS quality_score,
             []::VARCHAR[] AS warnings, start + INTERVAL 1 DAY AS created_at, start + INTERVAL 2 DAY AS updated_at
      FROM runs WHERE day(day) >= 15)
SELECT COALESCE(e.run_id, i.run_id) AS run_id, COALESCE(e.source, i.source) AS source,
       COALESCE(e.mode, i.mode) AS mode,
       CASE WHEN i.run_id IS NOT NULL THEN i.status ELSE e.status END AS status,
       CASE WHEN i.run_id IS NOT NULL THEN i.records ELSE e.records END AS records,
       CASE WHEN i.run_id IS NOT NULL THEN i.quality_score ELSE e.quality_score END AS quality_score,
       array_to_string(CASE WHEN i.run_id IS NOT NULL THEN i.warnings ELSE e.warnings END, '; ') AS warnings_text,
       COALESCE(e.created_at, i.created_at) AS created_at,
       CASE WHEN i.run_id IS NOT NULL THEN i.updated_at ELSE e.updated_at END AS updated_at
FROM e FULL JOIN i ON e.run_id = i.run_id"""


@register("run_audit_upsert", UPSERT_SQL)
def q_run_audit_upsert(spark, sf_dir):
    """SNK8: upsert of a second run batch onto the stored snapshot."""
    existing, incoming = _audit_batches(spark, sf_dir)
    snap = audit.upsert_runs(existing, incoming)
    return snap.select("run_id", "source", "mode", "status", "records", "quality_score",
                       F.array_join("warnings", "; ").alias("warnings_text"), "created_at", "updated_at")


@register("recent_runs", f"""
SELECT run_id, source, created_at FROM ({UPSERT_SQL}) u ORDER BY created_at DESC, run_id LIMIT 5""")
def q_recent_runs(spark, sf_dir):
    """SRT2: the newest five runs of the audit table (a top-k report)."""
    existing, incoming = _audit_batches(spark, sf_dir)
    snap = audit.upsert_runs(existing, incoming)
    return marts.recent(snap.select("run_id", "source", "created_at"), "created_at", 5, "run_id")


@register("serialized_sizes", """
SELECT run_id, sum(strlen(CAST(to_json({'id': event_id, 'source': event_type, 'user_id': user_id, 'props': props}) AS VARCHAR))) AS data_size_bytes,
       count(*) AS records
FROM (SELECT *, event_type || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id FROM events) e GROUP BY run_id""")
def q_serialized_sizes(spark, sf_dir):
    """AGG17: serialised JSON size of every run's event records (integer and text fields,
    whose JSON form both engines write the same way)."""
    e = table(spark, sf_dir, "events")
    run = F.concat_ws("-", F.col("event_type"), F.date_format(F.to_date("ts"), "yyyyMMdd"))
    rows = e.select(run.alias("run_id"), F.col("event_id").alias("id"), F.col("event_type").alias("source"), "user_id", "props")
    return rows.groupBy("run_id").agg(audit.data_size_bytes(rows.select("id", "source", "user_id", "props")), F.count(F.lit(1)).alias("records"))
