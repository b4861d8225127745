"""Preparation queries over the dirty events fixture (PRE1-PRE7, AGG6-AGG12, JN1, WIN2-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import prepare as prep
from tidemark.operators.modes import certified_modes
from tidemark.plans import fixtures as fx
from tidemark.functions.values import exact_sum
from tidemark.sources.tables import table
from tidemark.plans.registry import r2, register, xsum


_PREPARED: dict[tuple, prep.Prepared] = {}


def prepared_events(spark, sf_dir, with_corrections: bool = True) -> prep.Prepared:
    """The preparation of the dirty events (plan definitions reused per session)."""
    key = (id(spark), sf_dir, with_corrections)
    if key not in _PREPARED:
        raw = fx.dirty_events(spark, sf_dir)
        corrections = fx.event_corrections(spark, sf_dir) if with_corrections else None
        _PREPARED[key] = prep.prepare(raw, corrections, id_col="id", ordinal="id")
    return _PREPARED[key]


# --- SQL building blocks ---------------------------------------------------------
TRIM = "NULLIF(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '')"

CLEANED_SQL = f"""
SELECT id, {TRIM.format('event_type')} AS event_type, value, user_id, completed,
       {TRIM.format('note')} AS note, ts
FROM ({fx.DIRTY_EVENTS_SQL}) d"""

DEFAULTS_SQL = f"""
SELECT round_even(avg(value), 2) AS value,
       CAST(round_even(avg(user_id), 0) AS BIGINT) AS user_id,
       CASE WHEN count(completed) > 0 THEN count_if(completed) >= count(completed) / 2 END AS completed,
       COALESCE((SELECT event_type FROM cleaned WHERE event_type IS NOT NULL
                 GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1), 'IMPUTED_UNKNOWN') AS event_type,
       COALESCE((SELECT note FROM cleaned WHERE note IS NOT NULL
                 GROUP BY note ORDER BY count(*) DESC, note LIMIT 1), 'IMPUTED_UNKNOWN') AS note,
       (SELECT ts FROM cleaned WHERE ts IS NOT NULL GROUP BY ts ORDER BY count(*) DESC, ts LIMIT 1) AS ts
FROM cleaned"""

IMPUTED_SQL = """
SELECT c.id, COALESCE(c.event_type, d.event_type) AS event_type, COALESCE(c.value, d.value) AS value,
       COALESCE(c.user_id, d.user_id) AS user_id, COALESCE(c.completed, d.completed) AS completed,
       COALESCE(c.note, d.note) AS note, COALESCE(c.ts, d.ts) AS ts
FROM cleaned c CROSS JOIN defaults d"""

STAGED_SQL = f"""
SELECT c.seq, c.record_id, c."column", c.value, i.id AS target_id,
       CASE c."column" WHEN 'id' THEN CAST(i.id AS VARCHAR) WHEN 'event_type' THEN i.event_type
            WHEN 'value' THEN CAST(i.value AS VARCHAR) WHEN 'user_id' THEN CAST(i.user_id AS VARCHAR)
            WHEN 'completed' THEN CAST(i.completed AS VARCHAR) WHEN 'note' THEN i.note
            WHEN 'ts' THEN CAST(i.ts AS VARCHAR) END AS cell,
       {TRIM.format('c.value')} AS v
FROM ({fx.CORRECTIONS_SQL}) c LEFT JOIN imputed i ON CAST(i.id AS VARCHAR) = c.record_id"""

CHECKED_SQL = """
SELECT *,
       CASE "column"
            WHEN 'value' THEN CAST(TRY_CAST(v AS DOUBLE) AS VARCHAR)
            WHEN 'user_id' THEN CAST(TRY_CAST(v AS BIGINT) AS VARCHAR)
            WHEN 'id' THEN CAST(TRY_CAST(v AS BIGINT) AS VARCHAR)
            WHEN 'completed' THEN CASE WHEN v IS NOT NULL THEN CAST(lower(v) IN ('1', 'true', 'yes', 'ha') AS VARCHAR) END
            WHEN 'ts' THEN CAST(TRY_CAST(v AS TIMESTAMP) AS VARCHAR)
            ELSE v END AS after_value,
       CASE WHEN target_id IS NULL THEN 'record topilmadi'
            WHEN "column" NOT IN ('id', 'event_type', 'value', 'user_id', 'completed', 'note', 'ts')
                 THEN 'record yoki column topilmadi'
            WHEN "column" = 'value' AND v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL THEN 'type_mismatch'
            WHEN "column" IN ('user_id', 'id') AND v IS NOT NULL AND TRY_CAST(v AS BIGINT) IS NULL THEN 'type_mismatch'
            WHEN "column" = 'ts' AND v IS NOT NULL AND TRY_CAST(v AS TIMESTAMP) IS NULL THEN 'type_mismatch'
       END AS reason
FROM staged"""

AUDIT_SQL = """
SELECT seq, record_id, "column", value, 'applied' AS status, CAST(NULL AS VARCHAR) AS reason,
       CASE WHEN lag(seq) OVER w IS NULL THEN cell ELSE lag(after_value) OVER w END AS before,
       after_value AS after
FROM checked WHERE reason IS NULL
WINDOW w AS (PARTITION BY record_id, "column" ORDER BY seq)
UNION ALL
SELECT seq, record_id, "column", value, 'rejected', reason, NULL, NULL FROM checked WHERE reason IS NOT NULL"""

FIXES_SQL = """
SELECT record_id,
       max(CASE WHEN "column" = 'event_type' THEN 1 END) AS has_event_type,
       max(CASE WHEN "column" = 'event_type' THEN after_value END) AS fix_event_type,
       max(CASE WHEN "column" = 'value' THEN 1 END) AS has_value,
       max(CASE WHEN "column" = 'value' THEN after_value END) AS fix_value,
       max(CASE WHEN "column" = 'user_id' THEN 1 END) AS has_user_id,
       max(CASE WHEN "column" = 'user_id' THEN after_value END) AS fix_user_id,
       max(CASE WHEN "column" = 'completed' THEN 1 END) AS has_completed,
       max(CASE WHEN "column" = 'completed' THEN after_value END) AS fix_completed
FROM (SELECT *, row_number() OVER (PARTITION BY record_id, "column" ORDER BY seq DESC) AS rn
      FROM checked WHERE reason IS NULL) t
WHERE rn = 1
GROUP BY record_id"""

CORRECTED_SQL = """
SELECT i.id,
       CASE WHEN f.has_event_type = 1 THEN f.fix_event_type ELSE i.event_type END AS event_type,
       CASE WHEN f.has_value = 1 THEN TRY_CAST(f.fix_value AS DOUBLE) ELSE i.value END AS value,
       CASE WHEN f.has_user_id = 1 THEN TRY_CAST(f.fix_user_id AS BIGINT) ELSE i.user_id END AS user_id,
       CASE WHEN f.has_completed = 1 THEN TRY_CAST(f.fix_completed AS BOOLEAN) ELSE i.completed END AS completed,
       i.note, i.ts
FROM imputed i LEFT JOIN fixes f ON CAST(i.id AS VARCHAR) = f.record_id"""


def with_ctes(*names: str) -> str:
    blocks = {
        "cleaned": CLEANED_SQL, "defaults": DEFAULTS_SQL, "imputed": IMPUTED_SQL,
        "staged": STAGED_SQL, "checked": CHECKED_SQL, "audit": AUDIT_SQL, "fixes": FIXES_SQL,
        "corrected": CORRECTED_SQL,
    }
    return "WITH " + ",\n".join(f"{n} AS ({blocks[n]})" for n in names)


CORE = ("cleaned", "defaults", "imputed")
FULL = CORE + ("staged", "checked", "audit", "fixes", "corrected")


# --- queries --------------------------------------------------------------------
@register("trim_blank", f"{with_ctes('cleaned')} SELECT * FROM cleaned")
def q_trim_blank(spark, sf_dir):
    """PRE1 + PRE2 on every row of the dirty events."""
    return prep.trim_blank(fx.dirty_events(spark, sf_dir))


@register("column_defaults", f"{with_ctes('cleaned', 'defaults')} SELECT * FROM defaults")
def q_column_defaults(spark, sf_dir):
    """AGG6-AGG10: one row of column defaults (mean int, mean float, majority, mode)."""
    cleaned = prep.trim_blank(fx.dirty_events(spark, sf_dir))
    num_row, text_row = prep.column_defaults(cleaned)
    text = text_row.select(F.struct(*text_row.columns)).scalar()
    return num_row.select(*num_row.columns, *[text.getField(c).alias(c) for c in text_row.columns])


@register("imputed_rows", f"{with_ctes(*CORE)} SELECT * FROM imputed")
def q_imputed_rows(spark, sf_dir):
    """PRE3: every row with NULLs replaced by the column default."""
    return prepared_events(spark, sf_dir, with_corrections=False).imputed


@register("imputation_log", f"""{with_ctes(*CORE)}
SELECT CASE WHEN id IS NOT NULL AND id <> 0 THEN CAST(id AS VARCHAR) ELSE 'unknown' END AS record_id,
       col AS "column", 'column_default' AS method, val AS value
FROM (
  SELECT c.id, 'event_type' AS col, d.event_type AS val FROM cleaned c, defaults d WHERE c.event_type IS NULL
  UNION ALL SELECT c.id, 'value', CAST(d.value AS VARCHAR) FROM cleaned c, defaults d
            WHERE c.value IS NULL AND d.value IS NOT NULL
  UNION ALL SELECT c.id, 'user_id', CAST(d.user_id AS VARCHAR) FROM cleaned c, defaults d
            WHERE c.user_id IS NULL AND d.user_id IS NOT NULL
  UNION ALL SELECT c.id, 'completed', CAST(d.completed AS VARCHAR) FROM cleaned c, defaults d
            WHERE c.completed IS NULL AND d.completed IS NOT NULL
  UNION ALL SELECT c.id, 'note', d.note FROM cleaned c, defaults d WHERE c.note IS NULL
  UNION ALL SELECT c.id, 'ts', CAST(d.ts AS VARCHAR) FROM cleaned c, defaults d
            WHERE c.ts IS NULL AND d.ts IS NOT NULL
) t""")
def q_imputation_log(spark, sf_dir):
    """PRE4: one row per imputed cell."""
    return prepared_events(spark, sf_dir, with_corrections=False).imputation_log


@register("apply_corrections", f"{with_ctes(*FULL)} SELECT * FROM corrected")
def q_apply_corrections(spark, sf_dir):
    """PRE5-PRE6 + JN1 + WIN2: prepared rows after every applied correction."""
    return prepared_events(spark, sf_dir).rows


@register("correction_audit", f"{with_ctes(*FULL)} SELECT * FROM audit")
def q_correction_audit(spark, sf_dir):
    """WIN3: applied and rejected corrections with their before/after values."""
    return prepared_events(spark, sf_dir).corrections


@register("rejected_corrections", f"""{with_ctes(*FULL)}
SELECT reason, count(*) AS corrections FROM audit WHERE status = 'rejected' GROUP BY reason""")
def q_rejected_corrections(spark, sf_dir):
    """Reject counts per reason (no such record / no such column / type mismatch)."""
    audit = prepared_events(spark, sf_dir).corrections
    return (audit.where(F.col("status") == "rejected").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("corrections")))


@register("prep_profile", f"""{with_ctes(*FULL)}
SELECT (SELECT count(*) FROM ({fx.DIRTY_EVENTS_SQL}) r) AS rows,
       CAST(7 AS BIGINT) AS columns,
       (SELECT sum(CASE WHEN event_type <> regexp_replace(event_type, '^\\s+|\\s+$', '', 'g') THEN 1 ELSE 0 END
                   + CASE WHEN note <> regexp_replace(note, '^\\s+|\\s+$', '', 'g') THEN 1 ELSE 0 END)
        FROM ({fx.DIRTY_EVENTS_SQL}) r) AS trimmed_values,
       (SELECT sum(CASE WHEN regexp_replace(event_type, '^\\s+|\\s+$', '', 'g') = '' THEN 1 ELSE 0 END
                   + CASE WHEN regexp_replace(note, '^\\s+|\\s+$', '', 'g') = '' THEN 1 ELSE 0 END)
        FROM ({fx.DIRTY_EVENTS_SQL}) r) AS blank_to_null,
       (SELECT count_if(c.event_type IS NULL) + count_if(c.value IS NULL AND d.value IS NOT NULL)
               + count_if(c.user_id IS NULL AND d.user_id IS NOT NULL)
               + count_if(c.completed IS NULL AND d.completed IS NOT NULL)
               + count_if(c.note IS NULL) + count_if(c.ts IS NULL AND d.ts IS NOT NULL)
        FROM cleaned c, defaults d) AS imputed_values,
       (SELECT count_if(status = 'applied') FROM audit) AS manual_corrections_applied,
       (SELECT count_if(status = 'rejected') FROM audit) AS manual_corrections_rejected""")
def q_prep_profile(spark, sf_dir):
    """PRE7 + AGG11: preparation counters in one row."""
    return prepared_events(spark, sf_dir).profile


@register("column_types", f"""{with_ctes(*FULL)}
SELECT 'id' AS "column", CASE WHEN count(id) > 0 THEN 'int' ELSE 'null' END AS type FROM corrected
UNION ALL SELECT 'event_type', CASE WHEN count(event_type) > 0 THEN 'str' ELSE 'null' END FROM corrected
UNION ALL SELECT 'value', CASE WHEN count(value) > 0 THEN 'float' ELSE 'null' END FROM corrected
UNION ALL SELECT 'user_id', CASE WHEN count(user_id) > 0 THEN 'int' ELSE 'null' END FROM corrected
UNION ALL SELECT 'completed', CASE WHEN count(completed) > 0 THEN 'bool' ELSE 'null' END FROM corrected
UNION ALL SELECT 'note', CASE WHEN count(note) > 0 THEN 'str' ELSE 'null' END FROM corrected
UNION ALL SELECT 'ts', CASE WHEN count(ts) > 0 THEN 'datetime' ELSE 'null' END FROM corrected""")
def q_column_types(spark, sf_dir):
    """AGG12: type name per column of the prepared rows."""
    return prepared_events(spark, sf_dir).column_types


@register("mean_defaults_by_day", f"""
WITH cleaned AS ({CLEANED_SQL})
SELECT CAST(ts AS DATE) AS day, round_even(avg(value), 2) AS value_default,
       CAST(round_even(avg(user_id), 0) AS BIGINT) AS user_id_default,
       count_if(completed) >= count(completed) / 2 AS completed_default,
       round({xsum('value')}, 2) AS value_sum
FROM cleaned GROUP BY CAST(ts AS DATE)""")
def q_mean_defaults_by_day(spark, sf_dir):
    """AGG6-AGG8 as grouped aggregates: per-day defaults (one partial per task and day)."""
    cleaned = prep.trim_blank(fx.dirty_events(spark, sf_dir))
    return cleaned.groupBy(F.to_date("ts").alias("day")).agg(
        F.bround(F.avg("value"), 2).alias("value_default"),
        F.bround(F.avg("user_id")).cast("bigint").alias("user_id_default"),
        (F.count_if(F.col("completed")) >= F.count("completed") / 2).alias("completed_default"),
        r2(exact_sum("value")).alias("value_sum"))


MODE_COLUMNS_SQL = {"flag": "l_returnflag", "line": "CAST(l_linenumber AS VARCHAR)", "order": "CAST(l_orderkey AS VARCHAR)",
                    "mixed": "CASE WHEN l_orderkey % 4 = 0 THEN 'common' ELSE 'order ' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) END",
                    "blank": "CASE WHEN l_linenumber = 1 THEN ' x ' WHEN l_linenumber = 2 THEN 'y' ELSE '  ' END"}


@register("certified_modes", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", {text} AS value FROM lineitem" for name, text in MODE_COLUMNS_SQL.items()) + """),
n AS (SELECT "column", value, count(*) AS n FROM c WHERE trim(value) <> '' GROUP BY ALL)
SELECT "column", value, n, CASE WHEN "column" <> 'order' THEN true END AS certified FROM n QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""")
def q_certified_modes(spark, sf_dir):
    """AGG9 + SRT3: most common values by frequent-items summaries and an exact recount; the column whose values all
    are rare is counted in full (unless one of them stands out in a small table, so its flag is not shown)."""
    li = table(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    other = F.concat(F.lit("order "), key.cast("string"), F.lit("/"), line.cast("string"))
    texts = {"flag": F.col("l_returnflag"), "line": line.cast("string"), "order": key.cast("string"),
             "mixed": F.when(key % 4 == 0, "common").otherwise(other),
             "blank": F.when(line == 1, " x ").when(line == 2, "y").otherwise("  ")}
    return certified_modes(li, texts).withColumn("certified", F.when(F.col("column") != "order", F.col("certified")))
