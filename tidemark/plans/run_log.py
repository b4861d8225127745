"""Stage rows of real runs over the landed source files, for the stage queries.

Four runs per session and data folder: the whole report, the report stopped at the quality gate, the report with an
event log that cannot be written (a warning), and all cart payloads in stream mode.  They run side by side, once; their
stage rows are stored and every stage query reads those.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import fixtures as fx
from tidemark.plans import runner
from tidemark.plans.q_sources import land_cart_payloads, land_report_csv
from tidemark.schema import RunRequest
from tidemark.session import shared_path
from tidemark.sinks import warehouse as wh

# Stages of a run in order, and those that count records.
CHAIN = ("fastapi", "kafka", "landing", "raw", "preparation", "gx", "spark", "curated", "clickhouse", "trino", "postgres")
COUNTED = {"fastapi", "kafka", "landing", "raw", "preparation", "spark", "curated", "clickhouse", "trino", "postgres"}

#: run id → request, whether its event log is blocked, stages it reaches, and the statuses that are not "done"
RUNS = {
    "report-whole": (RunRequest(), False, CHAIN, {}),
    "report-stopped": (RunRequest(failure_stage="gx"), False, CHAIN[:6] + CHAIN[-1:], {"gx": "error"}),
    "report-warned": (RunRequest(), True, CHAIN, {"kafka": "warning"}),
    "carts-stream": (RunRequest(source="carts", mode="stream"), False, CHAIN, {}),
}


def block_event_log(spark: SparkSession, root: str) -> None:
    """Put a file where the event log's folder would be."""
    fs, place = wh._jvm_fs(spark, f"{root}/events")
    fs.create(place).close()


@fx.memoized
def real_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage rows of ``RUNS`` with source, mode and the run's root folder."""
    report, carts = land_report_csv(spark, sf_dir), land_cart_payloads(spark, sf_dir)

    def one(run_id: str) -> DataFrame:
        request, blocked, _, _ = RUNS[run_id]
        root = shared_path(spark, "runs", run_id)
        if blocked:
            block_event_log(spark, root)
        source = carts if request.source == "carts" else report
        result = runner.run(spark, request, input_path=source, layout="lines", root=root, run_id=run_id)
        return result.stages.withColumns({"source": F.lit(request.source), "mode": F.lit(request.mode), "root": F.lit(root)})

    path = shared_path(spark, "staging", "run-log")
    with ThreadPoolExecutor(len(RUNS)) as pool:
        for stages in list(pool.map(one, RUNS)):  # at most twelve rows each
            stages.coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _rows() -> str:
    out = []
    for run_id, (request, _, stages, status) in RUNS.items():
        for k, s in enumerate(stages):
            state = status.get(s, "done")
            out.append(f"('{run_id}', '{request.source}', '{request.mode}', {k + 1}, '{s}', '{state}', {int(s in COUNTED and state == 'done')})")
    return ", ".join(out)


RUN_LOG_SQL = f"""
SELECT run_id, source, mode, sequence, id, status,
       CAST(counted * CASE source WHEN 'carts' THEN (SELECT count(*) FROM ({fx.CARTS_SQL}) c) ELSE (SELECT count(*) FROM part) END AS BIGINT) AS records
FROM (VALUES {_rows()}) v(run_id, source, mode, sequence, id, status, counted)"""
