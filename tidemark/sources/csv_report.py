"""Semicolon report CSV: scan, per-column typing, record ids, pages, page stats.

SRC4-SRC9.  Cells are read as text, then one aggregate pass decides each
column's type (D4): BIGINT when every non-blank cell is an integer of 64 bits,
DOUBLE when every one is a number (decimal comma allowed) and no integer is
longer, else text.  A column with over-long digits stays text, so no digit is
lost; number cells of a text column are still found cell by cell (PRJ7).
Identifier columns always stay text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null
from tidemark.functions.values import DECIMAL_PATTERN, INTEGER_PATTERN, clamp, quoted
from tidemark.schema import LIMIT_MAX, LIMIT_MIN
from tidemark.sources.ordinal import ROW_NUMBER, page, with_row_number
from tidemark.sources.quoted_csv import has_quoted_breaks, read_quoted_csv

# Identifier columns of the report format.
IDENTIFIER_COLUMNS = ("inn", "soato", "okpo")


def read_report_csv(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """SRC4: ``;``-separated, header, quoted fields, UTF-8 (a BOM is dropped).

    Every cell is read as text; typing happens in ``type_columns``.  ``multiline`` lets one task read each
    file; ``load_report`` reads files with quoted line breaks in many tasks instead.
    """
    return (spark.read.option("sep", ";").option("header", True).option("quote", '"')
            .option("escape", '"').option("encoding", "UTF-8").option("multiLine", multiline)
            .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))


def column_kinds(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """D4: one aggregate decides BIGINT / DOUBLE / STRING for every column."""
    aggs = []
    for k, c in enumerate(columns):
        v = blank_to_null(quoted(c))
        aggs.append(F.count_if(v.isNotNull() & ~v.rlike(INTEGER_PATTERN)).alias(f"ni{k}"))
        aggs.append(F.count_if(v.isNotNull() & ~(v.rlike(INTEGER_PATTERN) | v.rlike(DECIMAL_PATTERN))).alias(f"nn{k}"))
        aggs.append(F.count_if(v.rlike(INTEGER_PATTERN) & v.try_cast("bigint").isNull()).alias(f"big{k}"))
    row = df.agg(*aggs).first() if aggs else None
    kinds = {}
    for k, c in enumerate(columns):
        if c in IDENTIFIER_COLUMNS or row[f"big{k}"]:
            kinds[c] = "string"
        elif row[f"ni{k}"] == 0:
            kinds[c] = "bigint"
        elif row[f"nn{k}"] == 0:
            kinds[c] = "double"
        else:
            kinds[c] = "string"
    return kinds


def typed_cell(col: Column, kind: str) -> Column:
    """SRC6: trim, blank → NULL, then the column's type (decimal comma → dot)."""
    v = blank_to_null(col)
    if kind == "bigint":
        return v.try_cast("bigint")
    if kind == "double":
        return F.replace(v, F.lit(","), F.lit(".")).try_cast("double")
    return v


def type_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Typed columns in their original order; other columns pass through."""
    return df.select(*[typed_cell(quoted(c), kinds[c]).alias(c) if c in kinds else quoted(c) for c in df.columns])


def with_record_id(df: DataFrame) -> DataFrame:
    """SRC9: ``{inn or 'unknown'}:{row_number}``."""
    inn = F.col("inn").cast("string") if "inn" in df.columns else F.lit(None).cast("string")
    return df.withColumn("id", F.concat(F.coalesce(F.nullif(inn, F.lit("")), F.lit("unknown")), F.lit(":"),
                                        F.col(ROW_NUMBER).cast("string")))


def load_report(spark: SparkSession, path: str, *, quoted_breaks: bool | None = None, kinds: dict[str, str] | None = None,
                split_bytes: int | None = None) -> DataFrame:
    """Scan → stored ordinal → typing → record id: the report's raw rows.

    A report whose lines are all records is read by the plain splittable reader.  One with line breaks inside quoted
    cells goes through ``quoted_csv``, which is parallel too.  ``quoted_breaks`` says which; None looks at the lines.
    The kinds are decided by one aggregate over the cells; ``kinds`` from an earlier load or a declared schema skips it.
    """
    if quoted_breaks is None:
        quoted_breaks = has_quoted_breaks(spark, path)
    if quoted_breaks:
        numbered = read_quoted_csv(spark, path, split_bytes=split_bytes)
        plain = numbered.drop(ROW_NUMBER)
    else:
        plain = read_report_csv(spark, path)
        numbered = None
    kinds = kinds or column_kinds(plain, plain.columns)
    return with_record_id(type_columns(with_row_number(plain) if numbered is None else numbered, kinds))


def report_page(rows: DataFrame, *, skip: int = 0, limit: int = 20) -> DataFrame:
    """SRC5: one page; limit clamped to 1..100, skip to ≥ 0."""
    return page(rows, skip, clamp(limit, LIMIT_MIN, LIMIT_MAX))


def page_stats(rows: DataFrame, data_columns: list[str], page_size: int = 20) -> DataFrame:
    """SRC7 + SRC8 for every page at once: rows, NULL cells, distinct
    organisations (non-empty inn), column count."""
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in data_columns), F.lit(0))
    page_no = F.floor((F.col(ROW_NUMBER) - 1) / page_size).cast("bigint")
    inn = F.nullif(F.col("inn").cast("string"), F.lit("")) if "inn" in rows.columns else F.lit(None)
    return rows.groupBy(page_no.alias("page")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(nulls).cast("bigint").alias("null_cells"),
        F.count_distinct(inn).alias("organizations"),
        F.lit(len(data_columns)).alias("column_count"))


def total_rows(rows: DataFrame) -> DataFrame:
    """SRC7: data rows without the header."""
    return rows.agg(F.count(F.lit(1)).alias("total"))
