"""Batch curate job (PRJ9, SNK5): raw JSON records → curated Parquet.

    spark-submit -m tidemark.plans.curate_job --source users --run-id r1 \\
        --input s3a://bucket/raw/users/ --output s3a://bucket/curated/users/

One read, one mapping, one write; the row count is observed during the write
(no second job over the input).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.curate import curate
from tidemark.schema import MODES, RunRequest, get_source
from tidemark.session import build_session
from tidemark.sources import payload as pl
from tidemark.sources.ordinal import ROW_NUMBER, file_position, number_rows


def curate_to_parquet(spark: SparkSession, raw: DataFrame, output: str, *, source: str,
                      source_system: str | None = None, mode: str = "batch", run_id: str,
                      loaded_at: dt.datetime | None = None) -> int:
    """Curate ``raw`` (records with a stored ordinal) and overwrite ``output``."""
    src = get_source(source)
    curated = curate(raw, source_id=src.source_id, source_title=source_system or src.title, mode=mode,
                     run_id=run_id, loaded_at=loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                     mapping=src.mapping, ordinal=ROW_NUMBER if ROW_NUMBER in raw.columns else None)
    obs = Observation("curated_rows")
    curated.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(output)
    return int(obs.get["rows"])


def read_raw_records(spark: SparkSession, path: str, *, layout: str = "document", collection: str) -> DataFrame:
    """Raw records with a stored ordinal; each payload may be an array of records,
    an object holding them under ``collection``, or (in lines) one bare record."""
    text = file_position(pl.read_payload_text(spark, path, layout=layout))
    bare = F.when(F.ltrim("value").startswith("{") & F.get_json_object("value", f"$.{collection}").isNull(),
                  F.concat(F.lit("["), "value", F.lit("]"))).otherwise(F.col("value"))
    records = pl.unwrap_text(text.withColumn("value", bare), collection, keep=("_file", "_block"))
    return pl.parse_records(number_rows(records.drop(pl.POSITION)))


OPTIONS = {
    "--source": "registered source the records belong to",
    "--source-system": "title stored with the curated rows (default: the registry's)",
    "--mode": f"ingestion mode, one of {', '.join(MODES)}",
    "--run-id": "run the rows are stored under",
    "--input": "folder or file of landed JSON",
    "--output": "folder that the curated Parquet replaces",
    "--layout": "'document' (one JSON document a file) or 'lines' (one payload a line)",
    "--collection": "key of the records in a payload object (default: the registry's)",
}


def main(argv: list[str] | None = None) -> int:
    """Check the request, curate, and report the observed count as one JSON line."""
    parser = argparse.ArgumentParser(prog="tidemark-curate", description=__doc__.splitlines()[0])
    for flag, text in OPTIONS.items():
        parser.add_argument(flag, help=text, required=flag in ("--source", "--run-id", "--input", "--output"),
                            default={"--mode": "batch", "--layout": "document"}.get(flag))
    given = parser.parse_args(argv)
    request = RunRequest(source=given.source, mode=given.mode)
    spark = build_session(app_name="tidemark-curate")
    records = read_raw_records(spark, given.input, layout=given.layout,
                               collection=given.collection or get_source(request.source).collection)
    rows = curate_to_parquet(spark, records, given.output, source=request.source, source_system=given.source_system,
                             mode=request.mode, run_id=given.run_id)
    print(json.dumps({"run_id": given.run_id, "curated_rows": rows, "output": given.output}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
