"""Quality queries (DQ1-DQ13) over the dirty events, prepared rows and curated sets."""

from __future__ import annotations

from tidemark.operators import quality as dq
from tidemark.plans import fixtures as fx
from tidemark.plans.catalog import CUR_ALL_SQL, curated_all
from tidemark.plans.q_prepare import FULL, prepared_events, with_ctes
from tidemark.plans.registry import register
from tidemark.sources.tables import table


def _checks_sql(source: str) -> str:
    empties = ("(CASE WHEN id IS NULL THEN 1 ELSE 0 END"
               " + CASE WHEN event_type IS NULL OR event_type = '' THEN 1 ELSE 0 END"
               " + CASE WHEN value IS NULL THEN 1 ELSE 0 END"
               " + CASE WHEN user_id IS NULL THEN 1 ELSE 0 END"
               " + CASE WHEN completed IS NULL THEN 1 ELSE 0 END"
               " + CASE WHEN note IS NULL OR note = '' THEN 1 ELSE 0 END"
               " + CASE WHEN ts IS NULL THEN 1 ELSE 0 END)")
    return f"""
SELECT count(*) AS total, count(id) AS has_id, count(*) AS has_data,
       sum(CASE WHEN {empties} / 7.0 < 0.35 THEN 1 ELSE 0 END) AS null_safe
FROM {source}"""


def _checks_rows(stats: str) -> str:
    return f"""
SELECT 'record_count' AS name, total > 0 AS passed, CAST(total AS VARCHAR) || ' rows' AS value FROM {stats}
UNION ALL SELECT 'primary_key', total > 0 AND has_id = total,
       CAST(has_id AS VARCHAR) || '/' || CAST(total AS VARCHAR) FROM {stats}
UNION ALL SELECT 'schema_not_empty', total > 0 AND has_data = total,
       CAST(has_data AS VARCHAR) || '/' || CAST(total AS VARCHAR) FROM {stats}
UNION ALL SELECT 'null_threshold', total > 0 AND null_safe / total >= 0.9,
       CAST(null_safe AS VARCHAR) || '/' || CAST(total AS VARCHAR) FROM {stats}"""


RAW_CHECKS_SQL = (f"WITH raw AS ({fx.DIRTY_EVENTS_SQL}), stats AS ({_checks_sql('raw')}), "
                  f"checks AS ({_checks_rows('stats')})")


@register("quality_checks", f"{RAW_CHECKS_SQL} SELECT * FROM checks")
def q_quality_checks(spark, sf_dir):
    """DQ1-DQ4 on the raw (dirty) rows."""
    return dq.quality_checks(fx.dirty_events(spark, sf_dir))


@register("quality_score", f"""{RAW_CHECKS_SQL}
SELECT CAST(round_even(count_if(passed) * 100.0 / count(*), 0) AS INTEGER) AS quality_score,
       count(*) AS checks_total, count_if(passed) AS checks_passed,
       CAST(round_even(count_if(passed) * 100.0 / count(*), 0) AS INTEGER) >= 90 AS strict_gate
FROM checks""")
def q_quality_score(spark, sf_dir):
    """DQ5-DQ6: score of the raw checks and the strict-gate flag."""
    return dq.quality_score(dq.quality_checks(fx.dirty_events(spark, sf_dir)))


@register("prepared_quality", f"""{with_ctes(*FULL)}, stats AS ({_checks_sql('corrected')}),
checks AS ({_checks_rows('stats')}) SELECT * FROM checks""")
def q_prepared_quality(spark, sf_dir):
    """DQ1-DQ4 on the prepared rows, as the run's quality stage does."""
    return dq.quality_checks(prepared_events(spark, sf_dir).rows)


@register("expectations", f"""WITH raw AS ({fx.DIRTY_EVENTS_SQL}),
e AS (
  SELECT 'expect_table_row_count_to_be_between' AS expectation, CAST(NULL AS VARCHAR) AS "column",
         count(*) >= 1 AS success, CAST(count(*) AS VARCHAR) AS observed FROM raw
  UNION ALL SELECT 'expect_column_values_to_not_be_null', 'id', count_if(id IS NULL) = 0,
         CAST(count_if(id IS NULL) AS VARCHAR) FROM raw
  UNION ALL SELECT 'expect_column_values_to_be_unique', 'id', count(id) - count(DISTINCT id) = 0,
         CAST(count(id) - count(DISTINCT id) AS VARCHAR) FROM raw
  UNION ALL SELECT 'expect_table_column_count_to_be_between', NULL, true, '7')
SELECT * FROM e
UNION ALL
SELECT 'suite', NULL, bool_and(success), CAST(count_if(success) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR)
FROM e""")
def q_expectations(spark, sf_dir):
    """DQ8-DQ12: raw expectation suite with overall success."""
    return dq.expectations(fx.dirty_events(spark, sf_dir))


@register("duplicate_keys", """
SELECT conv_id, count(*) AS rows FROM conversations GROUP BY conv_id HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    """DQ10 detail: keys that break uniqueness, here conversation ids across turns."""
    return dq.duplicate_keys(table(spark, sf_dir, "conversations"), "conv_id")


@register("not_null_tests", f"""WITH c AS ({CUR_ALL_SQL})
SELECT 'dw_id' AS "column", 'not_null' AS test, count_if(dw_id IS NULL) AS failures,
       count_if(dw_id IS NULL) = 0 AS passed FROM c
UNION ALL SELECT 'run_id', 'not_null', count_if(run_id IS NULL), count_if(run_id IS NULL) = 0 FROM c
UNION ALL SELECT 'source_entity', 'not_null', count_if(source_entity IS NULL),
       count_if(source_entity IS NULL) = 0 FROM c
UNION ALL SELECT 'metric_value', 'not_null', count_if(metric_value IS NULL),
       count_if(metric_value IS NULL) = 0 FROM c""")
def q_not_null_tests(spark, sf_dir):
    """DQ13: not-null model tests over the whole curated table."""
    return dq.not_null_tests(curated_all(spark, sf_dir))
