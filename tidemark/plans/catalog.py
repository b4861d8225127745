"""Curate and warehouse queries (PRJ*, AGG1-AGG5, AGG13-AGG14, FLT*, SRT*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import curate as cur
from tidemark.operators import marts
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import register, xsum
from tidemark.schema import SOURCES
from tidemark.session import shared_path
from tidemark.sinks import warehouse as wh

# Run ids of the fixture runs.
RUN_PART, RUN_CUSTOMER, RUN_ORDERS, RUN_LINEITEM = "run-part", "run-customer", "run-orders", "run-lineitem"
DELIVERY_RUN = "run-purchase"


# ---------------------------------------------------------------------------
# curated sets (Spark)
# ---------------------------------------------------------------------------
@fx.memoized
def curated_products(spark, sf_dir):
    s = SOURCES["products"]
    return cur.curate(fx.products_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                      mode="batch", run_id=RUN_PART, loaded_at=fx.PART_LOADED_AT)


@fx.memoized
def curated_users(spark, sf_dir):
    s = SOURCES["users"]
    return cur.curate(fx.users_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                      mode="api", run_id=RUN_CUSTOMER, loaded_at=fx.CUSTOMER_LOADED_AT)


@fx.memoized
def curated_carts(spark, sf_dir):
    s = SOURCES["carts"]
    return cur.curate(fx.carts_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                      mode="batch", run_id=RUN_ORDERS, loaded_at=F.col("order_date"))


@fx.memoized
def curated_posts(spark, sf_dir):
    s = SOURCES["posts"]
    return cur.curate(fx.posts_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                      mode="stream", run_id=F.col("run_id"), loaded_at=F.col("loaded_at"))


@fx.memoized
def curated_enterprise(spark, sf_dir):
    s = SOURCES["products"]
    return cur.curate(fx.enterprise_raw(spark, sf_dir), source_id=s.source_id, source_title=s.title,
                      mode="batch", run_id=RUN_LINEITEM, loaded_at=fx.LINEITEM_LOADED_AT)


@fx.memoized
def curated_all(spark, sf_dir):
    """Bag union of every curated fixture (SET2): the warehouse table."""
    out = curated_products(spark, sf_dir)
    for part in (curated_users, curated_carts, curated_posts, curated_enterprise):
        out = out.unionByName(part(spark, sf_dir))
    return out


@fx.memoized
def served(spark, sf_dir):
    """The appended warehouse table of the whole curated set, written once per session: files are
    sorted by run inside each source, so a run filter reaches the scan and skips row groups."""
    root = shared_path(spark, "served")
    wh.append_curated(curated_all(spark, sf_dir), root)
    return wh.read_curated(spark, root)


# ---------------------------------------------------------------------------
# curated sets (SQL)
# ---------------------------------------------------------------------------
CUR_PRODUCTS_SQL = f"""
SELECT 'products_' || CAST(id AS VARCHAR) AS dw_id, '{RUN_PART}' AS run_id,
       'eStat 4.0 - 12-korxona Iyun' AS source_system, 'products' AS source_entity,
       'batch' AS ingestion_mode, {fx.PART_LOADED_AT_SQL} AS loaded_at,
       title AS entity_name, category, 'price' AS metric_name,
       COALESCE(NULLIF(price, 0), 0.0) AS metric_value,
       COALESCE(NULLIF(availabilityStatus, ''), 'active') AS status
FROM ({fx.PRODUCTS_SQL}) raw"""

CUR_USERS_SQL = f"""
SELECT 'users_' || CAST(id AS VARCHAR) AS dw_id, '{RUN_CUSTOMER}' AS run_id,
       'SIAT API' AS source_system, 'users' AS source_entity, 'api' AS ingestion_mode,
       {fx.CUSTOMER_LOADED_AT_SQL} AS loaded_at,
       concat_ws(' ', NULLIF(firstName, ''), NULLIF(lastName, '')) AS entity_name,
       COALESCE(NULLIF(department, ''), NULLIF(role, ''), 'user') AS category,
       'age' AS metric_name, COALESCE(NULLIF(age, 0), 0.0) AS metric_value,
       CASE WHEN email IS NOT NULL AND email <> '' THEN 'verified' ELSE 'missing_email' END AS status
FROM ({fx.USERS_SQL}) raw"""

CUR_CARTS_SQL = f"""
SELECT 'carts_' || CAST(id AS VARCHAR) AS dw_id, '{RUN_ORDERS}' AS run_id,
       'Planshet Survey' AS source_system, 'carts' AS source_entity, 'batch' AS ingestion_mode,
       order_date AS loaded_at,
       'Cart ' || COALESCE(CAST(id AS VARCHAR), 'None') AS entity_name,
       'user_' || COALESCE(CAST(userId AS VARCHAR), 'None') AS category,
       'total' AS metric_name, COALESCE(NULLIF(total, 0), 0.0) AS metric_value,
       CAST(COALESCE(NULLIF(totalProducts, 0), 0) AS VARCHAR) || ' products' AS status
FROM ({fx.CARTS_SQL}) raw"""

CUR_POSTS_SQL = f"""
SELECT 'posts_' || CAST(id AS VARCHAR) AS dw_id, run_id,
       'Excel / CSV' AS source_system, 'posts' AS source_entity, 'stream' AS ingestion_mode,
       loaded_at,
       COALESCE(NULLIF(title, ''), NULLIF(todo, ''), 'Record ' || CAST(id AS VARCHAR)) AS entity_name,
       CASE WHEN len(tags) > 0 AND COALESCE(tags[1], 'None') <> '' THEN COALESCE(tags[1], 'None')
            WHEN userId IS NOT NULL AND userId <> 0 THEN CAST(userId AS VARCHAR)
            ELSE 'general' END AS category,
       'generic_value' AS metric_name,
       COALESCE(CAST(NULLIF(likes, 0) AS DOUBLE), CASE WHEN completed THEN 1.0 ELSE 0.0 END) AS metric_value,
       CASE WHEN completed THEN 'completed' ELSE 'active' END AS status
FROM ({fx.POSTS_SQL}) raw"""

CUR_ENTERPRISE_SQL = f"""
SELECT 'products_' || id AS dw_id, '{RUN_LINEITEM}' AS run_id,
       'eStat 4.0 - 12-korxona Iyun' AS source_system, 'products' AS source_entity,
       'batch' AS ingestion_mode, {fx.LINEITEM_LOADED_AT_SQL} AS loaded_at,
       CASE WHEN inn <> '' THEN COALESCE(g3, 'INN ' || inn) ELSE title END AS entity_name,
       CASE WHEN inn <> '' THEN 'section_' || COALESCE(NULLIF(section, ''), 'unknown') ELSE category END AS category,
       CASE WHEN inn <> '' THEN
            CASE WHEN g4 IS NOT NULL THEN 'g4' WHEN g5 IS NOT NULL THEN 'g5' WHEN g6 IS NOT NULL THEN 'g6'
                 WHEN g2 IS NOT NULL THEN 'g2' WHEN g1 IS NOT NULL THEN 'g1' ELSE 'reported_value' END
            ELSE 'price' END AS metric_name,
       CASE WHEN inn <> '' THEN COALESCE(g4, g5, g6, g2, CAST(g1 AS DOUBLE), 0.0)
            ELSE COALESCE(NULLIF(price, 0), 0.0) END AS metric_value,
       CASE WHEN inn <> '' THEN 'status_' || COALESCE(NULLIF(status, ''), 'unknown') ELSE 'active' END AS status
FROM ({fx.ENTERPRISE_SQL}) raw"""

CUR_ALL_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({q}) t{i}" for i, q in enumerate(
        [CUR_PRODUCTS_SQL, CUR_USERS_SQL, CUR_CARTS_SQL, CUR_POSTS_SQL, CUR_ENTERPRISE_SQL]))


# ---------------------------------------------------------------------------
# curate and mart queries
# ---------------------------------------------------------------------------
register("curate_products", CUR_PRODUCTS_SQL)(curated_products)
register("curate_users", CUR_USERS_SQL)(curated_users)
register("curate_carts", CUR_CARTS_SQL)(curated_carts)
register("curate_generic", CUR_POSTS_SQL)(curated_posts)
register("first_numeric_metric", CUR_ENTERPRISE_SQL)(curated_enterprise)


@register("fct_source_metrics", f"""
SELECT source_entity, category, metric_name, CAST(loaded_at AS DATE) AS load_date,
       count(*) AS record_count, {xsum('metric_value')} AS metric_sum,
       {xsum('metric_value')} / count(metric_value) AS metric_avg, max(loaded_at) AS last_loaded_at
FROM ({CUR_ALL_SQL}) c
GROUP BY source_entity, category, metric_name, CAST(loaded_at AS DATE)""")
def q_fct_source_metrics(spark, sf_dir):
    return marts.daily_metrics(curated_all(spark, sf_dir))


@register("run_check", f"""
SELECT count(*) AS records, COALESCE({xsum('metric_value')}, 0) AS metric_sum,
       count(DISTINCT source_entity) AS source_count
FROM ({CUR_POSTS_SQL}) c WHERE run_id = '{DELIVERY_RUN}'""")
def q_run_check(spark, sf_dir):
    return marts.run_check(served(spark, sf_dir), DELIVERY_RUN)


@register("run_checks", f"""
SELECT run_id, count(*) AS records, COALESCE({xsum('metric_value')}, 0) AS metric_sum,
       count(DISTINCT source_entity) AS source_count
FROM ({CUR_ALL_SQL}) c GROUP BY run_id""")
def q_run_checks(spark, sf_dir):
    return marts.run_checks(curated_all(spark, sf_dir))


@register("delivery_page", f"""
SELECT * FROM ({CUR_POSTS_SQL}) c WHERE run_id = '{DELIVERY_RUN}'
ORDER BY loaded_at DESC, dw_id LIMIT 20""")
def q_delivery_page(spark, sf_dir):
    return marts.delivery_page(served(spark, sf_dir), DELIVERY_RUN, limit=20)


@register("delivery_record", f"""
SELECT * FROM ({CUR_ALL_SQL}) c WHERE run_id = '{RUN_ORDERS}' AND dw_id = 'carts_7'
ORDER BY loaded_at DESC, dw_id LIMIT 100""")
def q_delivery_record(spark, sf_dir):
    return marts.delivery_page(served(spark, sf_dir), RUN_ORDERS, dw_id="carts_7", limit=100)


@register("delivery_summary", f"""
SELECT count(*) AS records_total, COALESCE({xsum('metric_value')}, 0) AS metric_sum
FROM ({CUR_POSTS_SQL}) c WHERE run_id = '{DELIVERY_RUN}'""")
def q_delivery_summary(spark, sf_dir):
    return marts.delivery_summary(served(spark, sf_dir), DELIVERY_RUN)


@register("entity_counts", f"""
SELECT source_entity, count(*) AS rows FROM ({CUR_ALL_SQL}) c GROUP BY source_entity""")
def q_entity_counts(spark, sf_dir):
    return marts.entity_counts(curated_all(spark, sf_dir))


@register("load_metric_sum", f"""
SELECT run_id, round_even({xsum('COALESCE(metric_value, 0)')}, 2) AS metric_sum
FROM ({CUR_ALL_SQL}) c GROUP BY run_id""")
def q_load_metric_sum(spark, sf_dir):
    return marts.load_metric_sum(curated_all(spark, sf_dir))


@register("category_histogram", f"""
WITH k AS (
SELECT COALESCE(category, entity_name, status, 'other') AS category_key, count(*) AS records,
       min(id) AS first_seen, {xsum('metric_value')} AS metric_total
FROM (SELECT c.*, CAST(split_part(dw_id, '_', 2) AS BIGINT) AS id FROM ({CUR_PRODUCTS_SQL}) c) t
GROUP BY COALESCE(category, entity_name, status, 'other')),
n AS (SELECT *, row_number() OVER (ORDER BY first_seen, category_key) AS nth FROM k)
SELECT category_key, records, first_seen, metric_total, nth <= 5 AS shown,
       max(records) FILTER (WHERE nth <= 5) OVER () AS max_count FROM n""")
def q_category_histogram(spark, sf_dir):
    c = curated_products(spark, sf_dir).withColumn(
        "id", F.split_part(F.col("dw_id"), F.lit("_"), F.lit(2)).cast("bigint"))
    return marts.category_histogram(c, "id")


@register("metric_total", f"""
SELECT {xsum('COALESCE(metric_value, 0.0)')} AS metric_total FROM ({CUR_ALL_SQL}) c""")
def q_metric_total(spark, sf_dir):
    """AGG14: total of ``metric_value ?? price ?? total ?? 0`` over every curated row."""
    return marts.metric_total(curated_all(spark, sf_dir))


# Sums of powers of two are exact in any order, so these groups compare although no decimal holds them.
EXTREME_SQL = f"""
SELECT source_entity, category, metric_name, CAST(loaded_at AS DATE) AS load_date,
       CASE CAST(split_part(dw_id, '_', 2) AS BIGINT) % 4 WHEN 0 THEN pow(2.0, -40) WHEN 1 THEN pow(2.0, 100)
            WHEN 2 THEN CAST('NaN' AS DOUBLE) ELSE metric_value END AS metric_value,
       CAST(split_part(dw_id, '_', 2) AS BIGINT) % 4 AS kind
FROM ({CUR_CARTS_SQL}) c"""


@register("mart_extreme_values", f"""
SELECT kind, count(*) AS record_count, isnan(sum(metric_value)) AS is_nan,
       CASE WHEN kind = 3 THEN {xsum("CASE WHEN kind = 3 THEN metric_value ELSE 0 END")} WHEN kind < 2 THEN sum(metric_value) END AS metric_sum
FROM ({EXTREME_SQL}) e GROUP BY kind""")
def q_mart_extreme_values(spark, sf_dir):
    """AGG1 over values that no DECIMAL(38,10) holds: tiny, huge and NaN are summed, not zeroed, dropped or fatal."""
    kind = F.split_part(F.col("dw_id"), F.lit("_"), F.lit(2)).cast("bigint") % 4
    value = (F.when(kind == 0, F.lit(2.0 ** -40)).when(kind == 1, F.lit(2.0 ** 100)).when(kind == 2, F.lit(float("nan")))
             .otherwise(F.col("metric_value")))
    rows = curated_carts(spark, sf_dir).withColumns({
        "metric_value": value, "category": kind.cast("string"), "loaded_at": F.to_timestamp(F.lit("2024-01-01"))})
    mart = marts.daily_metrics(rows)
    return mart.select(F.col("category").cast("bigint").alias("kind"), "record_count", F.isnan("metric_sum").alias("is_nan"),
                       F.when(~F.isnan("metric_sum"), F.col("metric_sum")).alias("metric_sum"))


@register("report_rows", f"""
SELECT dw_id, entity_name, category, metric_name, metric_value, status, loaded_at
FROM ({CUR_ALL_SQL}) c WHERE run_id = 'run-signup'
ORDER BY loaded_at DESC, dw_id LIMIT 100""")
def q_report_rows(spark, sf_dir):
    return marts.report_projection(served(spark, sf_dir), "run-signup", limit=100)
