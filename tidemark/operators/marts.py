"""Warehouse read side: daily mart, run checks, delivery pages, rollups.

AGG1-AGG5, AGG13-AGG14, FLT1-FLT3, SRT1-SRT5, PRJ11-PRJ14, SET3.

Every aggregate here is decomposable (count/sum/avg/max/min-of-struct), so
Spark runs a map-side partial aggregate before the shuffle and a hot key costs
one partial row per task instead of its rows.  Filters are plain column
predicates with bound literals, so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import clamp, exact_sum
from tidemark.schema import CURATED_COLUMNS, DESTINATION_PATTERN, LIMIT_DEFAULT, LIMIT_MAX, LIMIT_MIN

# Preferred display columns per view (PRJ14).
PREFERRED_CURATED = ["dw_id", "source_system", "entity_name", "category", "metric_name",
                     "metric_value", "status", "loaded_at"]
SHOWN_KEYS = 5
PREFERRED_RAW = ["id", "title", "firstName", "lastName", "category", "price", "total", "userId"]


def staging_view(curated: DataFrame) -> DataFrame:
    """PRJ11: the 11-column staging projection."""
    return curated.select(*CURATED_COLUMNS)


def daily_metrics(curated: DataFrame) -> DataFrame:
    """AGG1: count, sum, avg and last load per entity/category/metric/day.

    A NULL category is a group of its own (plain ``groupBy`` semantics).
    """
    return (
        curated.groupBy("source_entity", "category", "metric_name",
                        F.to_date("loaded_at").alias("load_date"))
        .agg(F.count(F.lit(1)).alias("record_count"),
             exact_sum("metric_value").alias("metric_sum"),
             F.count("metric_value").alias("_n"),
             F.max("loaded_at").alias("last_loaded_at"))
        .select("source_entity", "category", "metric_name", "load_date", "record_count", "metric_sum",
                F.try_divide(F.col("metric_sum"), F.col("_n")).alias("metric_avg"), "last_loaded_at")
    )


def run_filter(curated: DataFrame, run_id: str, dw_id: str | None = None) -> DataFrame:
    """FLT1/FLT2: equality on run and, when given, on record (bound literals)."""
    cond = F.col("run_id") == F.lit(run_id)
    if dw_id:
        cond = cond & (F.col("dw_id") == F.lit(dw_id))
    return curated.where(cond)


def run_check(curated: DataFrame, run_id: str) -> DataFrame:
    """AGG2: records, metric sum (0 when empty) and distinct sources of one run.

    A global aggregate returns exactly one row, also for an unknown run.
    """
    return run_filter(curated, run_id).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(exact_sum("metric_value"), F.lit(0.0)).alias("metric_sum"),
        F.count_distinct("source_entity").alias("source_count"),
    )


def run_checks(curated: DataFrame) -> DataFrame:
    """AGG2 for every run at once (one shuffle on run_id instead of one job per run)."""
    return curated.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(exact_sum("metric_value"), F.lit(0.0)).alias("metric_sum"),
        F.count_distinct("source_entity").alias("source_count"),
    )


def delivery_page(curated: DataFrame, run_id: str, *, dw_id: str | None = None,
                  limit: int = LIMIT_DEFAULT) -> DataFrame:
    """FLT1-2 + SRT1: newest rows of a run, ``loaded_at desc, dw_id``, limit 1..100.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its own
    top ``limit`` rows, so the single final task merges ``limit × tasks`` rows.
    """
    n = clamp(limit, LIMIT_MIN, LIMIT_MAX)
    return (run_filter(curated, run_id, dw_id).select(*CURATED_COLUMNS)
            .orderBy(F.col("loaded_at").desc(), F.col("dw_id").asc()).limit(n))


def delivery_summary(curated: DataFrame, run_id: str, *, dw_id: str | None = None) -> DataFrame:
    """AGG3: count and metric sum over *all* matching rows, not the page."""
    return run_filter(curated, run_id, dw_id).agg(
        F.count(F.lit(1)).alias("records_total"),
        F.coalesce(exact_sum("metric_value"), F.lit(0.0)).alias("metric_sum"),
    )


def entity_counts(curated: DataFrame) -> DataFrame:
    """AGG4: rows per source entity."""
    return curated.groupBy("source_entity").agg(F.count(F.lit(1)).alias("rows"))


def load_metric_sum(curated: DataFrame, by: str | None = "run_id") -> DataFrame:
    """AGG5: metric sum rounded half-even to two decimals (per run by default)."""
    total = F.bround(exact_sum(F.coalesce(F.col("metric_value"), F.lit(0.0))), 2).alias("metric_sum")
    return curated.groupBy(by).agg(total) if by else curated.agg(total)


def category_histogram(curated: DataFrame, ordinal: str | Column) -> DataFrame:
    """AGG13: rows per display key ``category ?? entity_name ?? status ?? 'other'``.

    ``first_seen`` is the smallest ordinal of the key, ``shown`` marks the first
    five keys in order of appearance and ``max_count`` (the largest count among
    the shown keys) scales their bars.  Both come from a five-row top-k and its
    maximum over the aggregated keys, never over rows.
    """
    ordinal_col = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    key = F.coalesce(F.col("category"), F.col("entity_name"), F.col("status"), F.lit("other"))
    keys = curated.groupBy(key.alias("category_key")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(ordinal_col).alias("first_seen"),
        exact_sum("metric_value").alias("metric_total"))
    top = keys.orderBy("first_seen", "category_key").limit(SHOWN_KEYS).agg(
        F.struct(F.max("records").alias("m"), F.max(F.struct("first_seen", "category_key")).alias("last")).alias("t"))
    rows = keys.withColumn("_top", top.scalar())
    shown = F.struct("first_seen", "category_key") <= F.col("_top.last")
    return rows.select("category_key", "records", "first_seen", "metric_total", shown.alias("shown"), F.col("_top.m").alias("max_count"))


def metric_total(curated: DataFrame) -> DataFrame:
    """AGG14: total of ``metric_value ?? price ?? total ?? 0`` over the rows."""
    parts = [F.col(c) for c in ("metric_value", "price", "total") if c in curated.columns]
    return curated.agg(exact_sum(F.coalesce(*parts, F.lit(0.0)).cast("double")).alias("metric_total"))


def recent(df: DataFrame, order_col: str, n: int, *tiebreak: str) -> DataFrame:
    """SRT2/SRT5: newest ``n`` rows (a top-k report: the limit is the feature);
    ``tiebreak`` columns make the choice deterministic among equal times."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tiebreak]).limit(n)


def sample_rows(df: DataFrame, ordinal: str, n: int = 3) -> DataFrame:
    """SRT4: first ``n`` rows in stored order."""
    return df.orderBy(F.col(ordinal).asc()).limit(n)


def report_projection(curated: DataFrame, run_id: str, limit: int = 100) -> DataFrame:
    """PRJ12 + FLT1 + SRT5: the seven report columns of one run, at most ``limit`` rows.

    The rows are the newest ones (``loaded_at desc, dw_id``) so the report is
    the same on every run; a bare ``limit`` would return arbitrary rows.
    """
    return (run_filter(curated, run_id)
            .select("dw_id", "entity_name", "category", "metric_name", "metric_value", "status", "loaded_at")
            .orderBy(F.col("loaded_at").desc(), F.col("dw_id").asc())
            .limit(limit))


def drop_internal(df: DataFrame) -> DataFrame:
    """PRJ13: drop columns whose name starts with ``__``."""
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def display_columns(columns: list[str], view: str, max_columns: int = 8) -> list[str]:
    """PRJ14: preferred columns that exist, then discovered ones, at most eight."""
    if not columns:
        return (["dw_id", "entity_name", "metric_value", "status"] if view == "curated"
                else ["id", "title", "category"])
    preferred = PREFERRED_CURATED if view == "curated" else PREFERRED_RAW
    ordered = [c for c in preferred if c in columns] + [c for c in columns if c not in preferred]
    return ordered[:max_columns]


def destinations(stages: DataFrame) -> DataFrame:
    """FLT3 + SET3: distinct output references that name a storage destination."""
    return (stages.where(F.col("output_ref").rlike(DESTINATION_PATTERN))
            .select("run_id", "output_ref").distinct())
