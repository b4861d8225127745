"""Curated metric-event mapping (PRJ1-PRJ10).

One ``select`` per branch, built from the input schema: a missing field reads as
NULL (PRJ10), falsy values follow the source's ``a or b`` rules (D3, D12).  The
whole mapping is a projection, so it fuses with the scan into one codegen stage
and never shuffles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import (
    as_double_or_zero,
    field,
    is_numeric,
    py_text,
    report_number,
    truthy,
)
from tidemark.schema import CURATED_COLUMNS, CURATED_SCHEMA

MAPPINGS = ("products", "users", "carts", "generic")

# The metric names and default labels of each branch.
ENTERPRISE_NUMBER_FIELDS = [f"g{i}" for i in range(4, 46)] + ["g2", "g1"]
FALLBACK_METRIC = "reported_value"


def _timestamp(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value.replace("Z", "+00:00")))
    if isinstance(value, dt.datetime):
        return F.lit(value).cast("timestamp")
    raise TypeError("loaded_at must be a Column, ISO text or datetime")


def first_numeric_metric(df: DataFrame) -> Column:
    """PRJ7: ``struct(metric_name, metric_value)`` of the first number in g4..g45, g2, g1.

    Decided cell by cell: in a text column (one bad cell makes the whole column
    text) a cell that reads as a number of the report format still counts, so
    one bad cell never removes the column for other rows.  Booleans and over-long
    digit strings are not numbers; within a row the first number wins.
    """
    names, numbers = [], []
    for name in ENTERPRISE_NUMBER_FIELDS:
        col, dtype = field(df, name)
        if is_numeric(dtype) or isinstance(dtype, T.StringType):
            number = report_number(col) if isinstance(dtype, T.StringType) else col.cast("double")
            names.append(F.when(number.isNotNull(), F.lit(name)))
            numbers.append(number)
    # Two flat chains: a chain of structs would be evaluated whole for each of its fields.
    return F.struct(F.coalesce(*names, F.lit(FALLBACK_METRIC)).alias("metric_name"), F.coalesce(*numbers, F.lit(0.0)).alias("metric_value"))


def first_tag(df: DataFrame, name: str = "tags") -> Column:
    """PRJ8: first array element as text, NULL for a missing/empty/non-array field."""
    col, dtype = field(df, name)
    if not isinstance(dtype, T.ArrayType):
        return F.lit(None).cast("string")
    return F.when(F.size(col) > 0, py_text(F.get(col, 0), dtype.elementType))


def _falsy_text(df: DataFrame, *names: str) -> list[tuple[Column, T.DataType]]:
    out = []
    for name in names:
        col, dtype = field(df, name)
        out.append((col, dtype))
    return out


def _first_truthy_text(items: list[tuple[Column, T.DataType]], default: Column) -> Column:
    expr = default
    for col, dtype in reversed(items):
        if isinstance(dtype, T.NullType):
            continue
        expr = F.when(truthy(col, dtype), py_text(col, dtype)).otherwise(expr)
    return expr


def _text_or_none(df: DataFrame, name: str) -> Column:
    col, dtype = field(df, name)
    return py_text(col, dtype)


def _branch_products(df: DataFrame) -> dict[str, Column]:
    title, title_t = field(df, "title")
    category, category_t = field(df, "category")
    price, price_t = field(df, "price")
    avail, avail_t = field(df, "availabilityStatus")
    return {
        "entity_name": title.cast("string") if not isinstance(title_t, T.NullType) else F.lit(None).cast("string"),
        "category": category.cast("string") if not isinstance(category_t, T.NullType) else F.lit(None).cast("string"),
        "metric_name": F.lit("price"),
        "metric_value": as_double_or_zero(price, price_t),
        "status": _first_truthy_text([(avail, avail_t)], F.lit("active")),
    }


def _branch_enterprise(df: DataFrame) -> dict[str, Column]:
    inn, inn_t = field(df, "inn")
    g3, g3_t = field(df, "g3")
    metric = first_numeric_metric(df)
    section = _first_truthy_text(_falsy_text(df, "section"), F.lit("unknown"))
    status = _first_truthy_text(_falsy_text(df, "status"), F.lit("unknown"))
    entity = F.concat(F.lit("INN "), py_text(inn, inn_t))
    if not isinstance(g3_t, T.NullType):
        entity = F.when(g3.isNotNull(), py_text(g3, g3_t)).otherwise(entity)
    return {
        "entity_name": entity,
        "category": F.concat(F.lit("section_"), section),
        "metric_name": metric["metric_name"],
        "metric_value": metric["metric_value"],
        "status": F.concat(F.lit("status_"), status),
    }


def _branch_users(df: DataFrame) -> dict[str, Column]:
    first, first_t = field(df, "firstName")
    last, last_t = field(df, "lastName")
    dept, dept_t = field(df, "company.department")
    role, role_t = field(df, "role")
    age, age_t = field(df, "age")
    email, email_t = field(df, "email")
    parts = [F.when(truthy(c, t), py_text(c, t)) for c, t in ((first, first_t), (last, last_t))
             if not isinstance(t, T.NullType)]
    return {
        "entity_name": F.concat_ws(" ", *parts) if parts else F.lit(""),
        "category": _first_truthy_text([(dept, dept_t), (role, role_t)], F.lit("user")),
        "metric_name": F.lit("age"),
        "metric_value": as_double_or_zero(age, age_t),
        "status": F.when(truthy(email, email_t), F.lit("verified")).otherwise(F.lit("missing_email")),
    }


def _branch_carts(df: DataFrame) -> dict[str, Column]:
    total, total_t = field(df, "total")
    count, count_t = field(df, "totalProducts")
    return {
        "entity_name": F.concat(F.lit("Cart "), _text_or_none(df, "id")),
        "category": F.concat(F.lit("user_"), _text_or_none(df, "userId")),
        "metric_name": F.lit("total"),
        "metric_value": as_double_or_zero(total, total_t),
        "status": F.concat(_first_truthy_text([(count, count_t)], F.lit("0")), F.lit(" products")),
    }


def _branch_generic(df: DataFrame) -> dict[str, Column]:
    likes, likes_t = field(df, "reactions.likes")
    completed, completed_t = field(df, "completed")
    done = (F.coalesce(completed == F.lit(True), F.lit(False))
            if isinstance(completed_t, T.BooleanType) else F.lit(False))
    tag = first_tag(df)
    user_text = _first_truthy_text(_falsy_text(df, "userId"), F.lit("general"))
    likes_value = (F.when(truthy(likes, likes_t), likes.cast("double"))
                   if is_numeric(likes_t) else F.lit(None).cast("double"))
    return {
        "entity_name": _first_truthy_text(
            _falsy_text(df, "title", "todo", "quote"),
            F.concat(F.lit("Record "), _text_or_none(df, "id")),
        ),
        "category": F.when(F.coalesce(tag != F.lit(""), F.lit(False)), tag).otherwise(user_text),
        "metric_name": F.lit("generic_value"),
        "metric_value": F.coalesce(likes_value, F.when(done, F.lit(1.0)).otherwise(F.lit(0.0))),
        "status": F.when(done, F.lit("completed")).otherwise(F.lit("active")),
    }


def curate(
    df: DataFrame,
    *,
    source_id: str,
    source_title: str,
    mode: str,
    run_id: str | Column,
    loaded_at,
    mapping: str | None = None,
    ordinal: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Map raw/prepared rows to the 11-column curated schema (PRJ1-PRJ6, PRJ9).

    ``carry`` names input columns appended after the curated ones (for example
    the stored ordinal, so later joins can use it).

    ``ordinal`` names the stored 1-based position column (D8); it replaces the
    id when the id is NULL or the field does not exist.  ``mapping`` picks the
    branch; by default ``products``/``users``/``carts`` use their own and every
    other source the generic branch.
    """
    mapping = mapping or (source_id if source_id in ("products", "users", "carts") else "generic")
    if mapping not in MAPPINGS:
        raise ValueError(f"unknown mapping {mapping!r}")

    id_col, id_t = field(df, "id")
    id_text = py_text(id_col, id_t)
    if isinstance(id_t, T.NullType) and not ordinal:
        raise ValueError("records without an id need a stored ordinal: every dw_id would be the same")
    if ordinal:
        position = F.col(ordinal).cast("string")
        id_text = (position if isinstance(id_t, T.NullType)
                   else F.when(id_col.isNotNull(), id_text).otherwise(position))

    common = {
        "dw_id": F.concat(F.lit(f"{source_id}_"), id_text),
        "run_id": run_id if isinstance(run_id, Column) else F.lit(run_id),
        "source_system": F.lit(source_title),
        "source_entity": F.lit(source_id),
        "ingestion_mode": F.lit(mode),
        "loaded_at": _timestamp(loaded_at),
    }

    if mapping == "products":
        inn, inn_t = field(df, "inn")
        product = _branch_products(df)
        if isinstance(inn_t, T.NullType):
            branch = product
        else:
            enterprise = _branch_enterprise(df)
            has_inn = truthy(inn, inn_t)
            branch = {k: F.when(has_inn, enterprise[k]).otherwise(product[k]) for k in product}
    elif mapping == "users":
        branch = _branch_users(df)
    elif mapping == "carts":
        branch = _branch_carts(df)
    else:
        branch = _branch_generic(df)

    cols = {**common, **branch}
    return df.select(*[cols[name].cast(CURATED_SCHEMA[name].dataType).alias(name) for name in CURATED_COLUMNS],
                     *[F.col(c) for c in carry])


def add_missing_columns(df: DataFrame, declared: T.StructType) -> DataFrame:
    """PRJ10: add declared columns that the input lacks as typed NULLs."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in declared.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df
