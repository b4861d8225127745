"""Fixed schemas, the source registry and request validation (SRC1, FLT4)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- curated metric event (column order is part of the contract) -----------
CURATED_COLUMNS = [
    "dw_id", "run_id", "source_system", "source_entity", "ingestion_mode", "loaded_at",
    "entity_name", "category", "metric_name", "metric_value", "status",
]

CURATED_SCHEMA = T.StructType([
    T.StructField("dw_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source_system", T.StringType(), False),
    T.StructField("source_entity", T.StringType(), False),
    T.StructField("ingestion_mode", T.StringType(), False),
    T.StructField("loaded_at", T.TimestampType(), False),
    T.StructField("entity_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType(), True),  # NULL: the source text was no number
    T.StructField("status", T.StringType(), False),
])

RUN_AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("records", T.LongType(), False),
    T.StructField("quality_score", T.IntegerType(), False),
    T.StructField("warnings", T.ArrayType(T.StringType()), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType(), False),
])

STAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("sequence", T.IntegerType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("ended_at", T.TimestampType(), False),
    T.StructField("duration_ms", T.LongType(), False),
    T.StructField("data_size_bytes", T.LongType(), False),
    T.StructField("data_format", T.StringType(), False),
    T.StructField("message", T.StringType(), True),
    T.StructField("warnings", T.ArrayType(T.StringType()), False),
    T.StructField("input_ref", T.StringType(), True),
    T.StructField("output_ref", T.StringType(), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("artifacts", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("input_preview", T.StringType(), True),
    T.StructField("output_preview", T.StringType(), True),
])

# Fixed value: output references that name a storage destination (FLT3).
DESTINATION_PATTERN = r"^(s3|local|clickhouse|postgres|kafka):"

# --- fixed values: choices the request accepts -----------------------------
MODES = ("batch", "stream", "api")
FAILURE_STAGES = ("none", "kafka", "gx", "clickhouse")
LIMIT_MIN, LIMIT_MAX, LIMIT_DEFAULT = 1, 100, 20  # of a delivery or report page; a run takes its whole input


@dataclass(frozen=True)
class Source:
    """One registry entry (SRC1).  ``mapping`` picks the curated branch (D10)."""

    source_id: str
    title: str
    endpoint: str
    collection: str
    entity: str
    mapping: str
    local_test: bool = False
    local_csv: bool = False


# The seven sources, their titles, endpoints and collection keys.
SOURCES: dict[str, Source] = {
    s.source_id: s
    for s in [
        Source("local_null_products", "Local Test API - Null Products", "/test-api/products-null",
               "products", "product", "generic", local_test=True),
        Source("products", "eStat 4.0 - 12-korxona Iyun", "/test-api/estat/12-korxona",
               "records", "enterprise_report", "products", local_test=True, local_csv=True),
        Source("users", "SIAT API", "/users", "users", "user", "users"),
        Source("carts", "Planshet Survey", "/carts", "carts", "cart", "carts"),
        Source("posts", "Excel / CSV", "/posts", "posts", "post", "generic"),
        Source("todos", "Batch Import", "/todos", "todos", "todo", "generic"),
        Source("quotes", "Imputatsiya tizimi", "/quotes", "quotes", "quote", "generic"),
    ]
}


def get_source(source_id: str) -> Source:
    """Registry lookup; an unknown id is an error (the API answered 404)."""
    try:
        return SOURCES[source_id]
    except KeyError:
        raise KeyError(f"Unknown source: {source_id}") from None


def sources_frame(spark):
    """The registry as a small DataFrame (fixed size: seven rows)."""
    rows = [(s.source_id, s.title, s.endpoint, s.collection, s.entity, s.mapping) for s in SOURCES.values()]
    return spark.createDataFrame(rows, "source_id string, title string, endpoint string, collection string, "
                                       "entity string, mapping string")


@dataclass
class RunRequest:
    """Validated run request (FLT4): checks happen before any plan is built."""

    source: str = "products"
    mode: str = "batch"
    failure_stage: str = "none"
    strict: bool = False
    corrections: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        get_source(self.source)
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.failure_stage not in FAILURE_STAGES:
            raise ValueError(f"failure_stage must be one of {FAILURE_STAGES}")
        for item in self.corrections:
            if not str(item.get("column") or ""):
                raise ValueError("correction column must not be empty")
