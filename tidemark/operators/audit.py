"""Stage log, run status, run audit upsert and their rollups.

AUD1-AUD7, AGG15-AGG18, SNK8.

A run has a bounded number of stages (twelve), so every per-run group here is
small by construction; the rollups are plain decomposable aggregates.  The
audit upsert is a full outer join of the stored snapshot with the incoming
batch on ``run_id`` (Parquet tables have no MERGE); the run log itself is
append-only, and ``latest_per_run`` reads the current row of each run from it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schema import DESTINATION_PATTERN, RUN_AUDIT_SCHEMA, STAGE_SCHEMA

# Stage pairs the console shows as one step (second folds into first).
MERGED_PAIRS = {"raw": "landing", "curated": "spark"}
# Metric keys searched, in order, for a stage's record count.
RECORD_COUNT_KEYS = ["records_received", "records_written", "records_in_event", "input_rows",
                     "output_rows", "inserted_rows", "records"]
DURATION_BUCKETS_MS = [100, 500, 1000, 5000, 30000]


def stage_rows(spark: SparkSession, stages: list[dict]) -> DataFrame:
    """AUD1: the driver-side stage records of one run as a DataFrame (≤ 12 rows)."""
    rows = []
    for s in stages:
        rows.append((
            s["run_id"], s["id"], s.get("name", s["id"]), s["status"], int(s["sequence"]),
            s["started_at"], s["ended_at"], int(s.get("duration_ms", 0)), int(s.get("data_size_bytes", 0)),
            s.get("data_format", "JSON"), s.get("message"), list(s.get("warnings", [])),
            s.get("input_ref"), s.get("output_ref"),
            {k: str(v) for k, v in (s.get("metrics") or {}).items()},
            {k: str(v) for k, v in (s.get("artifacts") or {}).items()},
            s.get("input_preview"), s.get("output_preview"),
        ))
    return spark.createDataFrame(rows, STAGE_SCHEMA)


def status_rank(col: Column) -> Column:
    return (F.when(col == "error", F.lit(2)).when(col == "warning", F.lit(1)).otherwise(F.lit(0)))


def rank_status(col: Column) -> Column:
    return F.when(col == 2, F.lit("error")).when(col == 1, F.lit("warning")).otherwise(F.lit("done"))


def run_status(stages: DataFrame) -> DataFrame:
    """AUD3: error if a stage failed, else warning if any warning, else done."""
    return stages.groupBy("run_id").agg(
        rank_status(F.max(F.greatest(status_rank(F.col("status")),
                                     F.when(F.size("warnings") > 0, F.lit(1)).otherwise(F.lit(0)))))
        .alias("status"),
        F.max(F.when(F.col("status") == "error", F.col("id"))).alias("failed_stage"),
        F.count(F.lit(1)).alias("stages"))


def stage_chain(stages: DataFrame) -> DataFrame:
    """AUD5: ``a -> b -> c`` in sequence order per run (bounded group)."""
    return stages.groupBy("run_id").agg(
        F.expr("listagg(id, ' -> ') WITHIN GROUP (ORDER BY sequence)").alias("chain"))


def stage_record_count(stages: DataFrame, fallback: Column | int = 0) -> Column:
    """AUD7: first metric among the seven keys that parses as a number."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(*[F.col("metrics")[k].try_cast("bigint") for k in RECORD_COUNT_KEYS], fb.cast("bigint"))


def merge_stage_pairs(stages: DataFrame) -> DataFrame:
    """AGG18: fold raw into landing and curated into spark.

    Worst status wins, durations and sizes add up, warnings concatenate and
    messages join in sequence order, metrics and artifacts merge with the later
    stage's value per key, and the output reference and end time are the later
    stage's.  A stage whose partner is missing stays under its own name.
    """
    both = Window.partitionBy("run_id")
    display = F.col("id")
    for second, first in MERGED_PAIRS.items():
        folds = F.max(F.col("id") == first).over(both) & (F.col("id") == second)
        display = F.when(folds, F.lit(first)).otherwise(display)
    named = stages.withColumn("display_stage", display)  # a run has at most twelve stages
    kept = [c for c in ("message", "output_ref", "metrics", "artifacts") if c in stages.columns]
    ordered = F.array_sort(F.collect_list(F.struct("sequence", "warnings", *kept)),  # two stages at most
                           lambda a, b: F.when(a["sequence"] < b["sequence"], -1).otherwise(1))
    grouped = named.groupBy("run_id", "display_stage").agg(
        rank_status(F.max(status_rank(F.col("status")))).alias("status"),
        F.min("sequence").alias("sequence"),
        F.sum("duration_ms").alias("duration_ms"),
        F.sum("data_size_bytes").alias("data_size_bytes"),
        ordered.alias("_parts"),
        F.max("ended_at").alias("ended_at"),
        F.count(F.lit(1)).alias("merged_stages"))

    def later(name: str) -> Column:
        return F.element_at(F.filter(F.col("_parts"), lambda p: p[name].isNotNull()), -1)[name]

    def merged(name: str) -> Column:
        maps = F.transform("_parts", lambda p: F.coalesce(p[name], F.create_map().cast("map<string,string>")))
        return F.aggregate(maps, F.create_map().cast("map<string,string>"),
                           lambda a, m: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(m, k)), m))

    extra = {"message": lambda: F.array_join(F.transform("_parts", lambda p: p["message"]), "; "),
             "output_ref": lambda: F.when(F.exists("_parts", lambda p: p["output_ref"].isNotNull()), later("output_ref")),
             "metrics": lambda: merged("metrics"), "artifacts": lambda: merged("artifacts")}
    return grouped.select(
        "run_id", "display_stage", "status", "sequence", "duration_ms", "data_size_bytes",
        F.flatten(F.transform("_parts", lambda p: p["warnings"])).alias("warnings"), "ended_at", "merged_stages",
        *[extra[c]().alias(c) for c in kept])


def run_report(stages: DataFrame) -> DataFrame:
    """AGG15 + FLT3: total stage time and the distinct storage destinations."""
    dest = F.when(F.col("output_ref").rlike(DESTINATION_PATTERN), F.col("output_ref"))
    return stages.groupBy("run_id").agg(
        F.sum("duration_ms").alias("stage_duration_ms"),
        F.count_distinct(dest).alias("destinations"),
        F.array_join(F.array_sort(F.collect_set(dest)), ", ").alias("destination_list"))


def run_metrics(runs: DataFrame, buckets=DURATION_BUCKETS_MS) -> DataFrame:
    """AGG16: run counter and duration histogram per (source, mode).

    Buckets are cumulative (``duration <= le``) like a scrape histogram.
    """
    aggs = [F.count(F.lit(1)).alias("runs"), F.sum("duration_ms").alias("duration_ms_sum")]
    aggs += [F.count_if(F.col("duration_ms") <= le).alias(f"le_{le}") for le in buckets]
    return runs.groupBy("source", "mode").agg(*aggs)


def data_size_bytes(df: DataFrame) -> Column:
    """AGG17: serialised size in bytes (JSON of each row, summed)."""
    return F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))).alias("data_size_bytes")


# ---------------------------------------------------------------------------
# SNK8: run audit upsert
# ---------------------------------------------------------------------------
def latest_per_run(batch: DataFrame) -> DataFrame:
    """One row per run: the row with the latest update wins and keeps the first
    creation time, source and mode (``max_by``/``min_by`` are decomposable, so a
    hot run id never lands in one task as rows)."""
    names = RUN_AUDIT_SCHEMA.fieldNames()
    first = ("source", "mode", "created_at")
    latest = F.max_by(F.struct(*[c for c in names if c != "run_id"]), F.col("updated_at"))
    earliest = F.min_by(F.struct(*first), F.struct("created_at", "updated_at"))
    rows = batch.groupBy("run_id").agg(latest.alias("l"), earliest.alias("f"))
    return rows.select(*[F.col(c) if c == "run_id" else F.col(f"f.{c}" if c in first else f"l.{c}") for c in names])


def upsert_runs(existing: DataFrame, incoming: DataFrame, now: dt.datetime | Column | None = None) -> DataFrame:
    """New run → insert; known run → replace status, records, quality_score,
    warnings and updated_at; keep source, mode and created_at."""
    e = existing.select(*[F.col(c).alias(f"e_{c}") for c in RUN_AUDIT_SCHEMA.fieldNames()])
    i = latest_per_run(incoming).select(*[F.col(c).alias(f"i_{c}") for c in RUN_AUDIT_SCHEMA.fieldNames()])
    j = e.join(i, e["e_run_id"] == i["i_run_id"], "full")
    has_new = F.col("i_run_id").isNotNull()
    stamp = (now if isinstance(now, Column) else F.lit(now).cast("timestamp")) if now is not None \
        else F.col("i_updated_at")

    def keep(c):
        return F.coalesce(F.col(f"e_{c}"), F.col(f"i_{c}")).alias(c)

    def replace(c, value=None):
        v = value if value is not None else F.col(f"i_{c}")
        return F.when(has_new, v).otherwise(F.col(f"e_{c}")).alias(c)

    return j.select(
        F.coalesce("e_run_id", "i_run_id").alias("run_id"),
        keep("source"), keep("mode"),
        replace("status"), replace("records"), replace("quality_score"), replace("warnings"),
        keep("created_at"),
        replace("updated_at", stamp),
    )
