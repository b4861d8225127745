"""Landed JSON payloads: scan, unwrap, counts, summaries, JSON paths.

SRC2, SRC3, SRC10-SRC14.  A payload is one JSON document: either an array of
records or an object holding the array under a collection key.  At scale the
landing zone holds many payloads; the scalable layout is JSON Lines (one
payload per line, splittable).  Records of whole-file documents come from
``document_records``, which reads large ones in many tasks.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import json_scan
from tidemark.sources.ordinal import file_position, number_rows

PAYLOAD_ID = "_payload"
POSITION = "_pos"
JSON_SPACE = " \t\r\n"
#: Documents beyond this size are read by ranges.
SCAN_FROM = 64 * 1024 * 1024


def read_payloads(spark: SparkSession, path: str, *, layout: str = "lines",
                  schema: T.StructType | None = None) -> DataFrame:
    """SRC2/SRC10/SRC11: ``lines`` = one payload per line, ``document`` = one
    JSON document (object or array) per file.  Give ``schema`` at scale: it
    skips the inference pass and keeps an empty input typed."""
    reader = spark.read.option("multiLine", layout == "document")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_payload_text(spark: SparkSession, path: str, *, layout: str = "lines") -> DataFrame:
    """The original payload text, never re-serialised (for the landing zone)."""
    return spark.read.text(path, wholetext=(layout == "document"))


def unwrap(payloads: DataFrame, collection_key: str, *, payload_id: str | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC3: records of the collection, one row each, with ``_pos`` (0-based
    position inside its payload) and the payload id when given.

    For payloads read with a schema.  A payload whose key is missing or not an
    array contributes no rows.  ``keep`` names payload columns copied onto every
    record.  Where arrays and objects may be mixed, see ``unwrap_text``.
    """
    field = payloads.schema[collection_key] if collection_key in payloads.columns else None
    if field is None or not isinstance(field.dataType, T.ArrayType):
        return payloads.limit(0)
    keep = [F.col(c) for c in ((payload_id,) if payload_id else ()) + tuple(keep)]
    exploded = payloads.select(*keep, F.posexplode(collection_key).alias(POSITION, "_r"))
    elem = field.dataType.elementType
    if isinstance(elem, T.StructType):
        return exploded.select(*keep, POSITION, "_r.*")
    return exploded.select(*keep, POSITION, F.col("_r").alias("value"))


def document_records(spark: SparkSession, path: str, collection_key: str, *, scan_from: int = SCAN_FROM) -> DataFrame:
    """SRC2 + SRC3 for whole-file documents: every record's JSON text as ``record`` with its ``_row_number``, in file and document order.

    Files up to ``scan_from`` bytes are read whole, a row each; where any is larger, records are found by ranges (``json_scan``).
    """
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]  # sizes only, no contents
    if (largest or 0) > scan_from:
        return json_scan.read_records(spark, path, collection_key).drop("_file")
    text = file_position(read_payload_text(spark, path, layout="document"))
    bare = F.regexp_replace("value", "\\A\ufeff", "")
    records = unwrap_text(text.withColumn("value", bare), collection_key, keep=("_file", "_block")).drop(POSITION)
    return number_rows(records)


def _collection(value: Column, collection_key: str) -> Column:
    """JSON text of a payload's records: the payload itself when it is an array,
    else its collection; decided for each payload on its own."""
    head = F.ltrim(value, F.lit(JSON_SPACE))
    inside = F.get_json_object(value, "$['" + collection_key.replace("'", "\\'") + "']")
    array = F.when(head.startswith("["), value).when(head.startswith("{") & F.ltrim(inside, F.lit(JSON_SPACE)).startswith("["), inside)
    return array


def unwrap_text(text: DataFrame, collection_key: str, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC3 + SRC10 over payload text (column ``value``): one row per record with
    ``keep``, ``_pos`` and the record's JSON text as ``record``.

    Each payload is an array of records or an object with the collection; the
    two may be mixed in one input.  A blank or broken payload, or one without the
    collection, contributes no rows (``payload_count`` shows it with 0).
    """
    items = F.from_json(_collection(F.col("value"), collection_key), "array<string>")
    return text.select(*keep, F.posexplode(items).alias(POSITION, "record"))


def parse_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Columns of the JSON text in ``record`` beside the other columns.  Without a
    schema one pass over the records infers it, as any JSON read does."""
    if schema is None:
        spark = records.sparkSession
        texts = getattr(records.select("record")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(texts).schema().json()))
    others = [c for c in records.columns if c != "record"]
    return records.withColumn("record", F.from_json("record", schema)).select(*others, "record.*")


def payload_count(text: DataFrame, collection_key: str) -> DataFrame:
    """SRC13: records per payload text (0 when it has no such collection); all columns stay."""
    return text.select("*", F.coalesce(F.json_array_length(_collection(F.col("value"), collection_key)), F.lit(0)).alias("records"))


def payload_summary(text: DataFrame, collection_key: str, sample: int = 3) -> DataFrame:
    """SRC14 over raw payload text (column ``value``): kind, top-level keys,
    record count and the first ``sample`` records as JSON."""
    v = F.col("value")
    head = F.ltrim(v, F.lit(JSON_SPACE))
    kind = F.when(head.startswith("["), F.lit("array")).when(head.startswith("{"), F.lit("object")) \
        .otherwise(F.lit("other"))
    coll = F.get_json_object(v, f"$.{collection_key}")
    records = F.when(kind == "array", F.json_array_length(v)).otherwise(F.coalesce(F.json_array_length(coll),
                                                                                   F.lit(0)))
    sample_of = F.when(kind == "array", v).otherwise(coll)
    items = F.from_json(sample_of, "array<string>")
    return text.select(
        "*", kind.alias("kind"),
        F.when(kind == "object", F.array_join(F.json_object_keys(v), ",")).alias("top_level_keys"),
        records.alias("records"),
        F.slice(items, 1, sample).alias("sample"))


def json_path(text: DataFrame, path: str, alias: str) -> DataFrame:
    """SRC12: extract one JSON path from the payload text as an attribute."""
    return text.select("*", F.get_json_object("value", path).alias(alias))


def union_ragged(*frames: DataFrame) -> DataFrame:
    """SET1: union of record sets whose column sets differ; a missing column
    reads as NULL (bag union, duplicates kept)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
