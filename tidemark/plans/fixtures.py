"""Source-shaped inputs derived from the driver tables.

The source system reads JSON records of seven sources and an enterprise CSV.
The driver data set is TPC-H shaped and has no NULLs or untrimmed text, so each
fixture below maps one driver table onto one source shape and injects defects
by a fixed rule on the row's own values.  Every fixture keeps *all* rows of its
table; the rules only decide which cells become NULL, blank or padded.

Each fixture exists twice: as DataFrame code (``*_raw``) and as the SQL text
(``*_SQL``) that the DuckDB oracle uses.  Both follow the rules written in the
docstrings; they are written independently so one checks the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import table

_MEMO: dict[tuple, DataFrame] = {}


def memoized(fn):
    """Reuse a fixture's DataFrame per (session, data folder).

    Only the plan definition is kept (no data is cached): every action still
    runs the whole plan, but the plan is not rebuilt through hundreds of
    Python → JVM calls each time a query mentions the fixture.
    """
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (fn.__name__, id(spark), sf_dir)
        if key not in _MEMO:
            _MEMO[key] = fn(spark, sf_dir)
        return _MEMO[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper

# Load time of the runs that have no time column of their own.
PART_LOADED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
CUSTOMER_LOADED_AT = dt.datetime(2024, 2, 2, 0, 0, 0)
LINEITEM_LOADED_AT = dt.datetime(2024, 2, 3, 0, 0, 0)
PART_LOADED_AT_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
CUSTOMER_LOADED_AT_SQL = "TIMESTAMP '2024-02-02 00:00:00'"
LINEITEM_LOADED_AT_SQL = "TIMESTAMP '2024-02-03 00:00:00'"


def _when(cond, value, other):
    return F.when(cond, value).otherwise(other)


# --- products (part) ----------------------------------------------------------
@memoized
def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part → product records.

    title NULL when ``p_size % 10 = 0``; price NULL when ``p_size % 7 = 0``;
    availabilityStatus ``''`` when ``p_size % 3 = 0``, else NULL when
    ``p_size % 5 = 0``, else ``p_brand``.
    """
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("id"),
        _when(size % 10 == 0, F.lit(None).cast("string"), F.col("p_name")).alias("title"),
        F.col("p_type").alias("category"),
        _when(size % 7 == 0, F.lit(None).cast("double"), F.col("p_retailprice")).alias("price"),
        _when(size % 3 == 0, F.lit(""),
              _when(size % 5 == 0, F.lit(None).cast("string"), F.col("p_brand"))).alias("availabilityStatus"),
    )


PRODUCTS_SQL = """
SELECT p_partkey AS id,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_name END AS title,
       p_type AS category,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS price,
       CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS availabilityStatus
FROM part"""


# --- users (customer) ---------------------------------------------------------
@memoized
def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → user records.

    firstName = c_name; lastName ``''`` when ``c_nationkey % 4 = 0`` else
    ``'N' || c_nationkey``; company.department NULL when c_acctbal < 0, ``''``
    when ``c_nationkey % 5 = 0``, else c_mktsegment; role NULL when
    ``c_nationkey % 3 = 0`` else ``'role_' || c_nationkey``; age = c_acctbal,
    NULL when ``c_custkey % 6 = 0``; email NULL when ``c_custkey % 8 = 0``,
    ``''`` when ``c_custkey % 8 = 1``, else derived from the name.
    """
    c = table(spark, sf_dir, "customer")
    nk, ck = F.col("c_nationkey"), F.col("c_custkey")
    dept = _when(F.col("c_acctbal") < 0, F.lit(None).cast("string"),
                 _when(nk % 5 == 0, F.lit(""), F.col("c_mktsegment")))
    return c.select(
        ck.alias("id"),
        F.col("c_name").alias("firstName"),
        _when(nk % 4 == 0, F.lit(""), F.concat(F.lit("N"), nk.cast("string"))).alias("lastName"),
        F.struct(dept.alias("department")).alias("company"),
        _when(nk % 3 == 0, F.lit(None).cast("string"), F.concat(F.lit("role_"), nk.cast("string"))).alias("role"),
        _when(ck % 6 == 0, F.lit(None).cast("double"), F.col("c_acctbal")).alias("age"),
        _when(ck % 8 == 0, F.lit(None).cast("string"),
              _when(ck % 8 == 1, F.lit(""),
                    F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                             F.lit("@example.com")))).alias("email"),
    )


USERS_SQL = """
SELECT c_custkey AS id,
       c_name AS firstName,
       CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS lastName,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey % 5 = 0 THEN '' ELSE c_mktsegment END AS department,
       CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE 'role_' || CAST(c_nationkey AS VARCHAR) END AS role,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS age,
       CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN ''
            ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email
FROM customer"""


# --- carts (orders + lineitem) --------------------------------------------------
@memoized
def carts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → cart records; totalProducts = number of line items (NULL if none).

    The line count is a partial/final aggregate on l_orderkey joined back on
    the order key: a shuffle on the key, no row of lineitem crosses the wire.
    """
    o = table(spark, sf_dir, "orders")
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("totalProducts")))
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("userId"),
                    F.col("o_totalprice").alias("total"), "totalProducts",
                    F.col("o_orderdate").alias("order_date")))


CARTS_SQL = """
SELECT o_orderkey AS id, o_custkey AS userId, o_totalprice AS total, l.totalProducts,
       o_orderdate AS order_date
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS totalProducts FROM lineitem GROUP BY l_orderkey) l
  ON o_orderkey = l.l_orderkey"""


# --- posts (events) -----------------------------------------------------------
@memoized
def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → generic post records; run = event type, load time = ts.

    title ``''`` for views, NULL for clicks, else ``event_type || ' event'``;
    todo ``'todo ' || event_id`` for clicks of even users; tags ``[]`` when
    ``user_id % 3 = 0``, ``[event_type]`` when 1, NULL when 2; likes = props.k;
    completed = event_type is purchase.
    """
    e = table(spark, sf_dir, "events")
    et, uid = F.col("event_type"), F.col("user_id")
    return e.select(
        F.col("event_id").alias("id"),
        _when(et == "view", F.lit(""),
              _when(et == "click", F.lit(None).cast("string"), F.concat(et, F.lit(" event")))).alias("title"),
        _when((et == "click") & (uid % 2 == 0), F.concat(F.lit("todo "), F.col("event_id").cast("string")),
              F.lit(None).cast("string")).alias("todo"),
        _when(uid % 3 == 0, F.array().cast("array<string>"),
              _when(uid % 3 == 1, F.array(et), F.lit(None).cast("array<string>"))).alias("tags"),
        uid.alias("userId"),
        F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("likes")).alias("reactions"),
        (et == "purchase").alias("completed"),
        F.concat(F.lit("run-"), et).alias("run_id"),
        F.col("ts").alias("loaded_at"),
    )


POSTS_SQL = """
SELECT event_id AS id,
       CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN NULL
            ELSE event_type || ' event' END AS title,
       CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'todo ' || CAST(event_id AS VARCHAR) END AS todo,
       CASE WHEN user_id % 3 = 0 THEN []::VARCHAR[] WHEN user_id % 3 = 1 THEN [event_type] END AS tags,
       user_id AS userId,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS likes,
       event_type = 'purchase' AS completed,
       'run-' || event_type AS run_id,
       ts AS loaded_at
FROM events"""


# --- enterprise report (lineitem) ------------------------------------------------
@memoized
def enterprise_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem → enterprise report records (the CSV source's shape).

    inn = l_orderkey as text, ``''`` for line 7 (those rows take the product
    branch); section = l_returnflag; status NULL for line status F;
    g1 = l_linenumber (NULL for line 1); g2 = l_quantity (NULL for lines 1-2);
    g3 = ``'Org ' || l_suppkey`` for odd lines else NULL; g4 = l_extendedprice
    (NULL when ``l_linenumber % 3 = 1``); g5 = l_discount (NULL when
    ``l_linenumber % 4 = 1``); g6 = l_tax (NULL for line 1); g7 = text code.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    inn = _when(ln == 7, F.lit(""), F.col("l_orderkey").cast("string"))
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), ln.cast("string")).alias("id"),
        inn.alias("inn"),
        F.col("l_returnflag").alias("section"),
        _when(F.col("l_linestatus") == "F", F.lit(None).cast("string"), F.col("l_linestatus")).alias("status"),
        _when(ln == 1, F.lit(None).cast("int"), ln).alias("g1"),
        _when(ln <= 2, F.lit(None).cast("double"), F.col("l_quantity")).alias("g2"),
        _when(ln % 2 == 1, F.concat(F.lit("Org "), F.col("l_suppkey").cast("string")),
              F.lit(None).cast("string")).alias("g3"),
        _when(ln % 3 == 1, F.lit(None).cast("double"), F.col("l_extendedprice")).alias("g4"),
        _when(ln % 4 == 1, F.lit(None).cast("double"), F.col("l_discount")).alias("g5"),
        _when(ln == 1, F.lit(None).cast("double"), F.col("l_tax")).alias("g6"),
        F.concat(F.lit("code_"), F.col("l_partkey").cast("string")).alias("g7"),
        F.concat(F.lit("Line "), ln.cast("string")).alias("title"),
        F.col("l_returnflag").alias("category"),
        F.col("l_extendedprice").alias("price"),
    )


ENTERPRISE_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS id,
       CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS inn,
       l_returnflag AS section,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END AS status,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS g1,
       CASE WHEN l_linenumber <= 2 THEN NULL ELSE l_quantity END AS g2,
       CASE WHEN l_linenumber % 2 = 1 THEN 'Org ' || CAST(l_suppkey AS VARCHAR) END AS g3,
       CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE l_extendedprice END AS g4,
       CASE WHEN l_linenumber % 4 = 1 THEN NULL ELSE l_discount END AS g5,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS g6,
       'code_' || CAST(l_partkey AS VARCHAR) AS g7,
       'Line ' || CAST(l_linenumber AS VARCHAR) AS title,
       l_returnflag AS category,
       l_extendedprice AS price
FROM lineitem"""


# --- dirty events for preparation -------------------------------------------------
@memoized
def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with injected defects, the input of every preparation query.

    event_type padded ``'  x '`` when ``event_id % 5 = 0``, ``''`` when
    ``event_id % 11 = 0``, a tab-padded value when ``event_id % 23 = 0``;
    value NULL when ``event_id % 7 = 0``; user_id NULL when ``event_id % 13 = 0``;
    completed (= purchase) NULL when ``event_id % 17 = 0``; note NULL for every
    row (an all-NULL text column).  ``id`` = event_id, which also serves as the
    stored ordinal.
    """
    e = table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    return e.select(
        eid.alias("id"),
        _when(eid % 5 == 0, F.concat(F.lit("  "), et, F.lit(" ")),
              _when(eid % 11 == 0, F.lit(""),
                    _when(eid % 23 == 0, F.concat(F.lit("\t"), et), et))).alias("event_type"),
        _when(eid % 7 == 0, F.lit(None).cast("double"), F.col("value")).alias("value"),
        _when(eid % 13 == 0, F.lit(None).cast("bigint"), F.col("user_id")).alias("user_id"),
        _when(eid % 17 == 0, F.lit(None).cast("boolean"), et == "purchase").alias("completed"),
        F.lit(None).cast("string").alias("note"),
        F.col("ts"),
    )


DIRTY_EVENTS_SQL = """
SELECT event_id AS id,
       CASE WHEN event_id % 5 = 0 THEN '  ' || event_type || ' '
            WHEN event_id % 11 = 0 THEN ''
            WHEN event_id % 23 = 0 THEN chr(9) || event_type
            ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type = 'purchase' END AS completed,
       CAST(NULL AS VARCHAR) AS note,
       ts
FROM events"""


@memoized
def event_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual corrections derived from events (seq orders them).

    Rules, each keyed on the row's own values:
      1. error events: value := text of ``round(value * 2, 2)``
      2. error events of even users: value := ``' ' || (value + 1) || ' '`` (a
         second correction on the same cell: its ``before`` is rule 1's after)
      3. signups of users divisible by 5: event_type := ``'corrected'``
      4. clicks of users divisible by 7: a record id that does not exist
      5. views of users divisible by 11: a column that does not exist
      6. purchases of users divisible by 13: user_id := ``'not-a-number'``
      7. purchases of users divisible by 3: completed := ``'ha'``
      8. signups of users divisible by 17: value := ``'   '`` (blank → NULL)
    """
    e = table(spark, sf_dir, "events")
    eid, et, uid = F.col("event_id"), F.col("event_type"), F.col("user_id")
    rid = eid.cast("string")
    rules = [
        (1, et == "error", rid, "value", F.bround(F.col("value") * 2, 2).cast("string")),
        (2, (et == "error") & (uid % 2 == 0), rid, "value",
         F.concat(F.lit(" "), (F.col("value") + 1).cast("string"), F.lit(" "))),
        (3, (et == "signup") & (uid % 5 == 0), rid, "event_type", F.lit("corrected")),
        (4, (et == "click") & (uid % 7 == 0), (eid + 1_000_000_000).cast("string"), "value", F.lit("1")),
        (5, (et == "view") & (uid % 11 == 0), rid, "no_such_column", F.lit("x")),
        (6, (et == "purchase") & (uid % 13 == 0), rid, "user_id", F.lit("not-a-number")),
        (7, (et == "purchase") & (uid % 3 == 0), rid, "completed", F.lit("ha")),
        (8, (et == "signup") & (uid % 17 == 0), rid, "value", F.lit("   ")),
    ]
    # One scan: every rule yields a struct or NULL, then one explode.
    items = F.array(*[
        F.when(cond, F.struct((eid * 10 + n).alias("seq"), record.alias("record_id"),
                              F.lit(column).alias("column"), value.alias("value")))
        for n, cond, record, column, value in rules
    ])
    return e.select(F.explode(items).alias("c")).where(F.col("c").isNotNull()).select("c.*")


CORRECTIONS_SQL = """
SELECT event_id * 10 + 1 AS seq, CAST(event_id AS VARCHAR) AS record_id, 'value' AS "column",
       CAST(round_even(value * 2, 2) AS VARCHAR) AS value FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id * 10 + 2, CAST(event_id AS VARCHAR), 'value', ' ' || CAST(value + 1 AS VARCHAR) || ' '
FROM events WHERE event_type = 'error' AND user_id % 2 = 0
UNION ALL
SELECT event_id * 10 + 3, CAST(event_id AS VARCHAR), 'event_type', 'corrected'
FROM events WHERE event_type = 'signup' AND user_id % 5 = 0
UNION ALL
SELECT event_id * 10 + 4, CAST(event_id + 1000000000 AS VARCHAR), 'value', '1'
FROM events WHERE event_type = 'click' AND user_id % 7 = 0
UNION ALL
SELECT event_id * 10 + 5, CAST(event_id AS VARCHAR), 'no_such_column', 'x'
FROM events WHERE event_type = 'view' AND user_id % 11 = 0
UNION ALL
SELECT event_id * 10 + 6, CAST(event_id AS VARCHAR), 'user_id', 'not-a-number'
FROM events WHERE event_type = 'purchase' AND user_id % 13 = 0
UNION ALL
SELECT event_id * 10 + 7, CAST(event_id AS VARCHAR), 'completed', 'ha'
FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0
UNION ALL
SELECT event_id * 10 + 8, CAST(event_id AS VARCHAR), 'value', '   '
FROM events WHERE event_type = 'signup' AND user_id % 17 = 0"""


# --- run stage log (events) --------------------------------------------------------
# Stage ids in run order (as in the source system's run log).
STAGES = ["fastapi", "kafka", "landing", "raw", "preparation", "gx", "spark", "curated",
          "clickhouse", "trino", "superset", "postgres"]
# Record-count metric key per stage (None: the stage reports no count).
STAGE_COUNT_KEY = {
    "fastapi": "records_received", "kafka": "records_in_event", "landing": "records_written",
    "raw": "records_written", "preparation": "input_rows", "gx": None, "spark": "output_rows",
    "curated": "records_written", "clickhouse": "inserted_rows", "trino": "records_queried",
    "superset": None, "postgres": "records",
}


@memoized
def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per (event type, day): the unit of the run audit queries and of the stage log.

    A partial/final aggregate; the result has (types × days) rows.
    """
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
                 F.count_if(F.col("value") > 45).alias("high"), F.min("ts").alias("start"))
            .select(F.concat_ws("-", F.col("source"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
                    "source",
                    F.when(F.col("source").isin("click", "view"), F.lit("stream")).otherwise(F.lit("batch"))
                    .alias("mode"),
                    "day", "n", "total", "high", "start"))


@memoized
def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve stages per event run, with defects decided by the run's values.

    Stage k (1-based) lasts ``n * k`` ms and starts ``k - 1`` minutes after the
    run's first event; landing is a *warning* (local fallback) when the run's
    mean value is above 25; gx is an *error* when more than one value in eight
    is above 45, and then every later stage is skipped.
    """
    runs = event_runs(spark, sf_dir)
    n, src, rid = F.col("n"), F.col("source"), F.col("run_id")
    warn_landing = F.col("total") > n * 25
    fail_gx = F.col("high") * 8 > n
    zone = lambda z: F.concat(F.lit("s3://raw/"), src, F.lit("/"), rid, F.lit(f"/{z}.json"))
    refs = {
        "fastapi": F.concat(F.lit("/test-api/"), src),
        "kafka": F.concat(F.lit("kafka://dwh.ingestion.events/"), rid),
        "landing": F.concat(F.when(warn_landing, F.lit("local://landing/")).otherwise(F.lit("s3://landing/")),
                            src, F.lit("/"), rid, F.lit("/landing.json")),
        "raw": zone("raw"), "preparation": zone("prepared"),
        "gx": F.lit("quality://checks"), "spark": F.lit("memory://curated_rows"), "curated": zone("curated"),
        "clickhouse": F.concat(F.lit("clickhouse://curated_events?rows="), n.cast("string")),
        "trino": F.lit("trino://curated_events"),
        "superset": F.concat(F.lit("http://dashboards/"), rid),
        "postgres": F.lit("postgres://pipeline_runs"),
    }
    items = []
    for k, sid in enumerate(STAGES, start=1):
        if sid == "landing":
            status = F.when(warn_landing, F.lit("warning")).otherwise(F.lit("done"))
        elif sid == "gx":
            status = F.when(fail_gx, F.lit("error")).otherwise(F.lit("done"))
        else:
            status = F.lit("done")
        warnings = F.when(status != "done", F.array(F.concat(F.lit(f"{sid}: "), status))).otherwise(
            F.array().cast("array<string>"))
        key = STAGE_COUNT_KEY[sid]
        metrics = (F.create_map(F.lit(key), n.cast("string")) if key
                   else F.create_map(F.lit("checks_total"), F.lit("4")))
        started = F.col("start") + F.make_interval(mins=F.lit(k - 1))
        items.append(F.struct(
            F.lit(sid).alias("id"), F.lit(k).alias("sequence"), status.alias("status"),
            (n * k).cast("bigint").alias("duration_ms"),
            (F.floor(F.col("total")) + k).cast("bigint").alias("data_size_bytes"),
            warnings.alias("warnings"), refs[sid].alias("output_ref"), metrics.alias("metrics"),
            started.alias("started_at"),
            (started + F.make_interval(secs=(n * k) / 1000.0)).alias("ended_at")))
    failed_at = F.when(fail_gx, F.lit(STAGES.index("gx") + 1)).otherwise(F.lit(len(STAGES)))
    return (runs.select("run_id", "source", "mode", failed_at.alias("_last"), F.inline(F.array(*items)))
            .where(F.col("sequence") <= F.col("_last")).drop("_last"))


STAGE_LOG_SQL = """
WITH runs AS (
  SELECT event_type || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, event_type AS source,
         CASE WHEN event_type IN ('click', 'view') THEN 'stream' ELSE 'batch' END AS mode,
         count(*) AS n, sum(value) AS total, count_if(value > 45) AS high, min(ts) AS start
  FROM events GROUP BY event_type, CAST(ts AS DATE)),
st(k, id, count_key) AS (VALUES (1, 'fastapi', 'records_received'), (2, 'kafka', 'records_in_event'),
  (3, 'landing', 'records_written'), (4, 'raw', 'records_written'), (5, 'preparation', 'input_rows'),
  (6, 'gx', NULL), (7, 'spark', 'output_rows'), (8, 'curated', 'records_written'),
  (9, 'clickhouse', 'inserted_rows'), (10, 'trino', 'records_queried'), (11, 'superset', NULL),
  (12, 'postgres', 'records')),
x AS (
  SELECT r.*, st.k AS sequence, st.id, st.count_key,
         CASE WHEN st.id = 'landing' AND r.total > r.n * 25 THEN 'warning'
              WHEN st.id = 'gx' AND r.high * 8 > r.n THEN 'error' ELSE 'done' END AS status
  FROM runs r CROSS JOIN st
  WHERE st.k <= CASE WHEN r.high * 8 > r.n THEN 6 ELSE 12 END)
SELECT run_id, source, mode, id, sequence, status,
       CAST(n * sequence AS BIGINT) AS duration_ms,
       CAST(floor(total) + sequence AS BIGINT) AS data_size_bytes,
       CASE WHEN status <> 'done' THEN [id || ': ' || status] ELSE []::VARCHAR[] END AS warnings,
       CASE id WHEN 'fastapi' THEN '/test-api/' || source
               WHEN 'kafka' THEN 'kafka://dwh.ingestion.events/' || run_id
               WHEN 'landing' THEN CASE WHEN status = 'warning' THEN 'local://landing/' ELSE 's3://landing/' END
                                   || source || '/' || run_id || '/landing.json'
               WHEN 'raw' THEN 's3://raw/' || source || '/' || run_id || '/raw.json'
               WHEN 'preparation' THEN 's3://raw/' || source || '/' || run_id || '/prepared.json'
               WHEN 'gx' THEN 'quality://checks' WHEN 'spark' THEN 'memory://curated_rows'
               WHEN 'curated' THEN 's3://raw/' || source || '/' || run_id || '/curated.json'
               WHEN 'clickhouse' THEN 'clickhouse://curated_events?rows=' || CAST(n AS VARCHAR)
               WHEN 'trino' THEN 'trino://curated_events'
               WHEN 'superset' THEN 'http://dashboards/' || run_id
               ELSE 'postgres://pipeline_runs' END AS output_ref,
       count_key, CAST(n AS VARCHAR) AS count_value,
       start + to_minutes(sequence - 1) AS started_at
FROM x"""
