"""Record lineage, dataset/record versions and field diff (JN2, JN3, VER1-VER3, DIF1).

Lineage joins the zones on the stored ordinal (D8), never on list position in
the driver.  The diff joins the two sides once on the record key and unpivots
afterwards, instead of unpivoting both sides and joining on (key, field): the
shuffle carries one row per record, not one per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import clean_name
from tidemark.functions.values import field, py_text, quoted

# Labels the lineage and version records carry.
LOCAL_SYSTEM = "Local Test API"
REMOTE_SYSTEM = "DummyJSON"
WAREHOUSE_DATABASE = "dwh"
WAREHOUSE_TABLE = "curated_events"
DATASET_FILE_NAMES = {
    "products": "12-korxona shakli_Iyun_1700_все.csv",
    "local_null_products": "local-null-products.json",
    "users": "siat-users.json",
    "carts": "planshet-survey.json",
}


def _struct_of(df: DataFrame, exclude: tuple[str, ...]) -> Column:
    return F.struct(*[quoted(c) for c in df.columns if c not in exclude])


def build_lineage(raw: DataFrame, prepared: DataFrame, curated: DataFrame | None, *,
                  source: str, run_id: str, ordinal: str, curate_fn=None) -> DataFrame:
    """JN2: one row per raw record with its prepared, curated and warehouse sides.

    All inputs carry ``ordinal``; prepared/curated may miss rows (left joins),
    ``record_id`` is the raw id, else the 0-based position.  With
    ``curate_fn(df, carry)`` instead of ``curated``, the curated side is
    computed from the prepared rows in the same projection: one join, and the
    preparation is not evaluated a second time for the curated side.
    """
    id_col, id_t = field(raw, "id")
    position = (F.col(ordinal) - 1).cast("string")
    record_id = position if isinstance(id_t, T.NullType) else py_text(id_col, id_t)
    source_id = id_col.cast("string") if not isinstance(id_t, T.NullType) else position
    system = LOCAL_SYSTEM if source == "local_null_products" else REMOTE_SYSTEM

    r = raw.select(F.col(ordinal).alias("_ord"), record_id.alias("record_id"), source_id.alias("_sid"),
                   _struct_of(raw, ()).alias("raw"))
    if curate_fn is not None:
        both = curate_fn(prepared, tuple(prepared.columns))
        cur_cols = [c for c in both.columns if c not in prepared.columns]
        p = both.select(F.col(ordinal).alias("_ord"),
                        F.struct(*[F.col(c) for c in prepared.columns]).alias("prepared"),
                        F.struct(*[F.col(c) for c in cur_cols]).alias("curated"))
        out = r.join(p, "_ord", "left")
        has_curated = True
    else:
        p = prepared.select(F.col(ordinal).alias("_ord"), _struct_of(prepared, ()).alias("prepared"))
        out = r.join(p, "_ord", "left")
        has_curated = curated is not None
        if has_curated:
            c = curated.select(F.col(ordinal).alias("_ord"), _struct_of(curated, ()).alias("curated"))
            out = out.join(c, "_ord", "left")
        else:
            out = out.withColumn("curated", F.lit(None))
    warehouse = F.when(
        F.col("curated").isNotNull(),
        F.struct(F.lit(WAREHOUSE_DATABASE).alias("database"), F.lit(WAREHOUSE_TABLE).alias("table"),
                 F.col("curated.dw_id").alias("key") if has_curated else F.lit(None).alias("key"),
                 F.lit(run_id).alias("run_id")))
    return out.select(
        F.col("_ord").alias(ordinal), "record_id",
        F.struct(F.lit(system).alias("system"), F.lit(source).alias("entity"),
                 F.col("_sid").alias("id")).alias("source"),
        "raw", "prepared", "curated", warehouse.alias("warehouse"))


def replace_prepared(lineage: DataFrame, new_prepared: DataFrame, key: str = "id", *, ordinal: str | None = None) -> DataFrame:
    """JN3: swap the prepared side by record id; keep the old one where absent.

    When several new rows have one id, the last one by ``ordinal`` counts (by
    the whole row where none is given), so lineage rows are never multiplied.

    When the new rows have the prepared side's fields, the struct keeps its
    type (fields reordered and cast); otherwise the side becomes JSON text.
    """
    cols = [c for c in new_prepared.columns if not c.startswith("__") and c != ordinal]
    old_type = lineage.schema["prepared"].dataType
    same_fields = isinstance(old_type, T.StructType) and set(old_type.fieldNames()) == set(cols)
    if same_fields:
        new_struct = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in old_type.fields])
    else:
        new_struct = F.struct(*[F.col(c) for c in cols])
    order = F.col(ordinal) if ordinal else F.to_json(new_struct)
    fresh = (new_prepared.select(F.col(key).cast("string").alias("_rid"), new_struct.alias("_new"), order.alias("_at"))
             .where(F.col("_rid").isNotNull()).groupBy("_rid").agg(F.max_by("_new", "_at").alias("_new")))
    joined = lineage.join(fresh, lineage["record_id"] == fresh["_rid"], "left")
    if same_fields:
        prepared = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("prepared"))
    else:
        prepared = F.when(F.col("_new").isNotNull(), F.to_json("_new")).otherwise(F.to_json("prepared"))
    return joined.select(*[F.col(c) for c in lineage.columns if c != "prepared"],
                         prepared.alias("prepared"), F.col("_new").isNotNull().alias("replaced"))


# ---------------------------------------------------------------------------
# VER1-VER3
# ---------------------------------------------------------------------------
def dataset_file_name(source: Column) -> Column:
    expr = F.concat(source, F.lit("-dataset.json"))
    for key, name in DATASET_FILE_NAMES.items():
        expr = F.when(source == F.lit(key), F.lit(name)).otherwise(expr)
    return expr


def dataset_versions(runs: DataFrame, prepared_version: str | None = None) -> DataFrame:
    """VER1: version ids per run from ``run_id`` and ``source`` (optionally an
    explicit ``prepared_version_id`` column or a fixed override)."""
    base = F.coalesce(F.nullif(F.substring(clean_name(F.col("source")), 1, 24), F.lit("")), F.lit("dataset"))
    explicit = (F.col("prepared_version_id") if "prepared_version_id" in runs.columns
                else F.lit(prepared_version).cast("string"))
    return runs.select(
        "run_id", "source",
        F.concat(F.lit("FILE-"), F.upper(F.substring("run_id", 1, 8))).alias("file_id"),
        dataset_file_name(F.col("source")).alias("file_name"),
        base.alias("base"),
        F.concat(F.lit("raw:"), base, F.lit(":v0")).alias("raw_version"),
        F.coalesce(explicit, F.concat(F.lit("prep:"), base, F.lit(":v1"))).alias("prepared_version"),
        F.concat(F.lit("integration:"), base, F.lit(":v2")).alias("integration_version"),
        F.concat(F.lit("metrics:"), base, F.lit(":v3")).alias("metrics_version"),
    )


def record_versions(rows: DataFrame, ordinal: str) -> DataFrame:
    """VER2: per-record version ids; base = last 8 cleaned chars of the record id,
    else the position, padded to two digits and never cut.  The ids are short labels;
    ``record_id`` is carried whole, as labels of different records may be equal."""
    ids = [F.col(c).cast("string") for c in ("id", "dw_id") if c in rows.columns]
    record_id = F.coalesce(*ids, F.concat(F.lit("row-"), F.col(ordinal).cast("string")))
    cleaned = clean_name(record_id)
    base = F.when(F.length(cleaned) > 0, F.right(cleaned, F.lit(8))).otherwise(
        F.lpad(F.col(ordinal).cast("string"), F.greatest(F.lit(2), F.length(F.col(ordinal).cast("string"))), F.lit("0")))
    return rows.select(
        F.col(ordinal), record_id.alias("record_id"),
        F.concat(F.lit("raw:"), base, F.lit(":v0")).alias("raw_version"),
        F.concat(F.lit("prep:"), base, F.lit(":v1")).alias("prepared_version"),
        F.concat(F.lit("qa:"), base, F.lit(":v2")).alias("quality_version"),
        F.concat(F.lit("dwh:"), base, F.lit(":v3")).alias("dwh_version"),
    )


def save_prepared_version(current: DataFrame, edited: DataFrame, version_id: str, *,
                          ordinal: str, key: str = "id") -> DataFrame:
    """VER3: replace prepared rows with an edited set and stamp the version id.

    Internal ``__`` fields are dropped; a row without id takes the id of the
    current row at the same position, else ``row-{n}``.  An edited set without
    rows, or with no columns besides the ordinal, is refused.
    """
    data_cols = [c for c in edited.columns if not c.startswith("__") and c != ordinal]
    if not data_cols:
        raise ValueError("an edited version needs at least one record field")
    if edited.limit(1).count() == 0:
        raise ValueError("an edited version needs at least one row")
    prev = current.select(F.col(ordinal).alias("_ord"), F.col(key).alias("_prev_id"))
    joined = edited.join(prev, edited[ordinal] == prev["_ord"], "left")
    own = F.col(key) if key in edited.columns else F.lit(None)
    new_id = F.coalesce(own.cast("string"), F.col("_prev_id").cast("string"),
                        F.concat(F.lit("row-"), F.col(ordinal).cast("string")))
    return joined.select(
        F.col(ordinal), *[F.col(c) for c in data_cols if c != key], new_id.alias(key),
        F.lit(version_id).alias("__prepared_version_id"))


# ---------------------------------------------------------------------------
# DIF1
# ---------------------------------------------------------------------------
def flatten_one_level(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, tuple[Column, T.DataType]]:
    """``a.b`` for struct fields one level down; other columns as they are."""
    out: dict[str, tuple[Column, T.DataType]] = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StructType):
            for sub in f.dataType.fields:
                out[f"{f.name}.{sub.name}"] = (quoted(f.name).getField(sub.name), sub.dataType)
        else:
            out[f.name] = (quoted(f.name), f.dataType)
    return out


def _json_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def field_diff(before: DataFrame, after: DataFrame, key: str = "id", *, ordinal: str | None = None) -> DataFrame:
    """DIF1: (key, field, state, before, after) for every record and field.

    The two sides meet on the stored ``ordinal``, so repeated or NULL ids neither
    multiply rows nor lose them; ``key`` is a carried label.  Without an ordinal
    the key must be unique and not NULL.  ``added``/``removed`` follow schema
    membership (a field only one side has); ``changed`` compares the values
    (NULL-safe), arrays whole.
    """
    inner = tuple({key, ordinal} - {None})
    b = flatten_one_level(before, inner)
    a = flatten_one_level(after, inner)
    on = ordinal or key
    left = before.select(F.col(on).alias("_at"), F.col(key).alias("_bk"), F.struct(*[c.alias(n) for n, (c, _) in b.items()]).alias("_b"))
    right = after.select(F.col(on).alias("_at"), F.col(key).alias("_ak"), F.struct(*[c.alias(n) for n, (c, _) in a.items()]).alias("_a"))
    joined = left.join(right, "_at", "full").withColumn("_k", F.coalesce("_ak", "_bk"))
    items = []
    for name in list(b) + [n for n in a if n not in b]:
        bv = _json_text(F.col("_b").getField(name), b[name][1]) if name in b else F.lit(None).cast("string")
        av = _json_text(F.col("_a").getField(name), a[name][1]) if name in a else F.lit(None).cast("string")
        if name not in b:
            state = F.lit("added")
        elif name not in a:
            state = F.lit("removed")
        else:
            state = (F.when(F.col("_b").isNull(), F.lit("added"))
                     .when(F.col("_a").isNull(), F.lit("removed"))
                     .when(bv.eqNullSafe(av), F.lit("same")).otherwise(F.lit("changed")))
        items.append(F.struct(F.lit(name).alias("field"), state.alias("state"), bv.alias("before"),
                              av.alias("after")))
    return joined.select(F.col("_k").alias(key), F.inline(F.array(*items)))
