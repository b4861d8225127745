"""Lineage, version and diff queries (JN2, JN3, VER1-VER3, DIF1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import curate as cur
from tidemark.operators import lineage as lin
from tidemark.plans import fixtures as fx
from tidemark.plans.q_prepare import FULL, prepared_events, with_ctes
from tidemark.plans.registry import register
from tidemark.schema import SOURCES
from tidemark.session import materialize

LINEAGE_RUN = "run-lineage"


@register("record_lineage", f"""{with_ctes(*FULL)}
SELECT CAST(r.id AS VARCHAR) AS record_id, 'DummyJSON' AS source_system, 'todos' AS source_entity,
       CAST(r.id AS VARCHAR) AS source_id, r.event_type AS raw_event_type, r.value AS raw_value,
       p.event_type AS prepared_event_type, p.value AS prepared_value, p.user_id AS prepared_user_id,
       'todos_' || CAST(p.id AS VARCHAR) AS curated_dw_id,
       CASE WHEN p.completed THEN 1.0 ELSE 0.0 END AS curated_metric_value,
       CASE WHEN p.completed THEN 'completed' ELSE 'active' END AS curated_status,
       'todos_' || CAST(p.id AS VARCHAR) AS warehouse_key, '{LINEAGE_RUN}' AS warehouse_run_id
FROM ({fx.DIRTY_EVENTS_SQL}) r LEFT JOIN corrected p ON r.id = p.id""")
def q_record_lineage(spark, sf_dir):
    """JN2: raw → prepared → curated → warehouse per record, joined on the ordinal."""
    raw = fx.dirty_events(spark, sf_dir)
    prepared = materialize(prepared_events(spark, sf_dir).rows)   # the written prepared zone
    s = SOURCES["todos"]

    def to_curated(df, carry):
        return cur.curate(df, source_id=s.source_id, source_title=s.title, mode="batch",
                          run_id=LINEAGE_RUN, loaded_at=F.col("ts"), carry=carry)

    lineage = lin.build_lineage(raw, prepared, None, source="todos", run_id=LINEAGE_RUN, ordinal="id",
                                curate_fn=to_curated)
    return lineage.select(
        "record_id", F.col("source.system").alias("source_system"), F.col("source.entity").alias("source_entity"),
        F.col("source.id").alias("source_id"),
        F.col("raw.event_type").alias("raw_event_type"), F.col("raw.value").alias("raw_value"),
        F.col("prepared.event_type").alias("prepared_event_type"),
        F.col("prepared.value").alias("prepared_value"), F.col("prepared.user_id").alias("prepared_user_id"),
        F.col("curated.dw_id").alias("curated_dw_id"), F.col("curated.metric_value").alias("curated_metric_value"),
        F.col("curated.status").alias("curated_status"), F.col("warehouse.key").alias("warehouse_key"),
        F.col("warehouse.run_id").alias("warehouse_run_id"))


def _edited(prepared):
    """The manual edit used by the version queries: the whole prepared set, with
    purchase values doubled and the id of view rows dropped (it falls back to the
    stored row's id)."""
    return prepared.select(
        F.col("id").alias("_row"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("bigint")).otherwise(F.col("id")).alias("id"),
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value") * 2).otherwise(F.col("value")).alias("value"),
        "user_id", "completed", "note", "ts",
        F.lit("scratch").alias("__edit_note"))


EDITED_SQL = """
SELECT id AS _row, CASE WHEN event_type = 'view' THEN NULL ELSE id END AS id, event_type,
       CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value, user_id, completed, note, ts
FROM corrected"""

VERSION_ID = "prep:events:manual-1"


@register("manual_version", f"""{with_ctes(*FULL)}, edited AS ({EDITED_SQL})
SELECT e._row, e.event_type, e.value, e.user_id, e.completed, e.note, e.ts,
       COALESCE(CAST(e.id AS VARCHAR), CAST(c.id AS VARCHAR), 'row-' || CAST(e._row AS VARCHAR)) AS id,
       '{VERSION_ID}' AS __prepared_version_id
FROM edited e LEFT JOIN corrected c ON e._row = c.id""")
def q_manual_version(spark, sf_dir):
    """VER3: an edited prepared set saved as a named version."""
    prepared = materialize(prepared_events(spark, sf_dir).rows)   # used twice below
    return lin.save_prepared_version(prepared.withColumn("_row", F.col("id")), _edited(prepared),
                                     VERSION_ID, ordinal="_row")


@register("lineage_replace", f"""{with_ctes(*FULL)}, edited AS ({EDITED_SQL}),
v AS (SELECT COALESCE(CAST(e.id AS VARCHAR), CAST(c.id AS VARCHAR), 'row-' || CAST(e._row AS VARCHAR)) AS id,
             e.value + 1 AS value FROM edited e LEFT JOIN corrected c ON e._row = c.id
      WHERE e.event_type IN ('purchase', 'view'))
SELECT CAST(r.id AS VARCHAR) AS record_id, COALESCE(v.value, p.value) AS prepared_value,
       v.id IS NOT NULL AS replaced
FROM ({fx.DIRTY_EVENTS_SQL}) r LEFT JOIN corrected p ON r.id = p.id
LEFT JOIN v ON CAST(r.id AS VARCHAR) = v.id""")
def q_lineage_replace(spark, sf_dir):
    """JN3: lineage whose prepared side is swapped for a saved manual version."""
    raw = fx.dirty_events(spark, sf_dir)
    prepared = materialize(prepared_events(spark, sf_dir).rows)   # used three times below
    lineage = lin.build_lineage(raw, prepared, None, source="todos", run_id=LINEAGE_RUN, ordinal="id")
    version = lin.save_prepared_version(prepared.withColumn("_row", F.col("id")), _edited(prepared),
                                        VERSION_ID, ordinal="_row")
    few = version.where(F.col("event_type").isin("purchase", "view"))
    twice = few.unionByName(few.withColumns({"_row": F.col("_row") + 10_000_000, "value": F.col("value") + 1}))  # a later edit of the same ids
    swapped = lin.replace_prepared(lineage, twice, key="id", ordinal="_row")
    return swapped.select("record_id", F.col("prepared.value").alias("prepared_value"), "replaced")


@register("dataset_versions", f"""
SELECT DISTINCT run_id, source, 'FILE-' || upper(substr(run_id, 1, 8)) AS file_id,
       source || '-dataset.json' AS file_name,
       COALESCE(NULLIF(substr(regexp_replace(source, '[^a-zA-Z0-9_-]', '', 'g'), 1, 24), ''), 'dataset') AS base,
       'raw:' || source || ':v0' AS raw_version,
       CASE WHEN source = 'purchase' THEN 'manual:' || run_id ELSE 'prep:' || source || ':v1' END AS prepared_version,
       'integration:' || source || ':v2' AS integration_version, 'metrics:' || source || ':v3' AS metrics_version
FROM (SELECT event_type || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, event_type AS source FROM events GROUP BY event_type, CAST(ts AS DATE)) s""")
def q_dataset_versions(spark, sf_dir):
    """VER1: dataset version ids per run (purchase runs carry a manual version)."""
    runs = fx.event_runs(spark, sf_dir).select("run_id", "source").withColumn(
        "prepared_version_id",
        F.when(F.col("source") == "purchase", F.concat(F.lit("manual:"), F.col("run_id"))))
    return lin.dataset_versions(runs)


@register("record_versions", """
SELECT id + 1 AS _row, 'posts_' || CAST(event_id AS VARCHAR) AS record_id,
       'raw:' || right(regexp_replace('posts_' || CAST(event_id AS VARCHAR), '[^a-zA-Z0-9_-]', '', 'g'), 8) || ':v0'
           AS raw_version,
       'prep:' || right('posts_' || CAST(event_id AS VARCHAR), 8) || ':v1' AS prepared_version,
       'qa:' || right('posts_' || CAST(event_id AS VARCHAR), 8) || ':v2' AS quality_version,
       'dwh:' || right('posts_' || CAST(event_id AS VARCHAR), 8) || ':v3' AS dwh_version
FROM (SELECT event_id, event_id AS id FROM events) e""")
def q_record_versions(spark, sf_dir):
    """VER2: per-record version ids of curated rows (dw_id as the record id)."""
    s = SOURCES["posts"]
    curated = cur.curate(fx.posts_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                         mode="stream", run_id=F.col("run_id"), loaded_at=F.col("loaded_at"), carry=("id",))
    rows = curated.select("dw_id", (F.col("id") + 1).alias("_row"))
    return lin.record_versions(rows, "_row")


def _diff_sql() -> str:
    fields = [("event_type", "r.event_type", "p.event_type"),
              ("value", "CAST(r.value AS VARCHAR)", "CAST(p.value AS VARCHAR)"),
              ("user_id", "CAST(r.user_id AS VARCHAR)", "CAST(p.user_id AS VARCHAR)"),
              ("completed", "CAST(r.completed AS VARCHAR)", "CAST(p.completed AS VARCHAR)"),
              ("note", "r.note", "p.note"),
              ("ts", "CAST(r.ts AS VARCHAR)", "CAST(p.ts AS VARCHAR)")]
    parts = [f"""SELECT COALESCE(r.id, p.id) AS id, '{name}' AS field, {b} AS before, {a} AS after,
       r.id IS NULL AS b_missing, p.id IS NULL AS a_missing
FROM ({fx.DIRTY_EVENTS_SQL}) r FULL JOIN corrected p ON r.id = p.id""" for name, b, a in fields]
    return f"""{with_ctes(*FULL)}
SELECT id, field,
       CASE WHEN b_missing THEN 'added' WHEN a_missing THEN 'removed'
            WHEN before IS NOT DISTINCT FROM after THEN 'same' ELSE 'changed' END AS state,
       before, after
FROM ({" UNION ALL ".join(parts)}) t"""


@register("field_diff", _diff_sql())
def q_field_diff(spark, sf_dir):
    """DIF1: per record and field, raw vs prepared: added/removed/changed/same."""
    prepared = materialize(prepared_events(spark, sf_dir).rows)   # the written prepared zone
    return lin.field_diff(fx.dirty_events(spark, sf_dir), prepared, key="id")
