"""Quality checks, expectation suite, not-null model tests and the gate (DQ1-DQ13).

Every check set is **one** global aggregate (decomposable: counts and sums),
unpivoted afterwards with ``explode`` over the single result row, so a suite
costs one scan of the data whatever the number of checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Check names and thresholds of the source system.
NULL_SHARE_LIMIT = 0.35
NULL_SAFE_SHARE = 0.9
STRICT_GATE_SCORE = 90
DEFAULT_MIN_SCORE = 100
NOT_NULL_COLUMNS = ["dw_id", "run_id", "source_entity", "metric_value"]


def _rec(names: list[str], *values) -> Column:
    """``struct`` with fixed field names, so items of one ``array`` share a type."""
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(names, values)])


class QualityGateError(RuntimeError):
    """Raised by ``assert_quality`` when the score is below the minimum (DQ7)."""


def _empty(col: Column, dtype: T.DataType) -> Column:
    """NULL, or ``''`` for text: the cell counts as empty."""
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == F.lit(""))
    return col.isNull()


def _checks_row(df: DataFrame, id_col: str) -> DataFrame:
    n_cols = len(df.columns)
    empties = sum((F.when(_empty(F.col(f.name), f.dataType), 1).otherwise(0) for f in df.schema.fields),
                  F.lit(0))
    has_id = F.count(F.col(id_col)) if id_col in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        has_id.alias("has_id"),
        (F.count(F.lit(1)) if n_cols > 1 else F.lit(0).cast("bigint")).alias("has_data"),
        F.count_if((empties / F.lit(max(n_cols, 1))) < F.lit(NULL_SHARE_LIMIT)).alias("null_safe"),
    )


def quality_checks(df: DataFrame, id_col: str = "id") -> DataFrame:
    """DQ1-DQ4: (name, passed, value) for record_count, primary_key,
    schema_not_empty and null_threshold."""
    s = _checks_row(df, id_col)
    total, has_id, has_data, null_safe = (F.col(c) for c in ("total", "has_id", "has_data", "null_safe"))
    ratio = lambda a: F.concat(a.cast("string"), F.lit("/"), total.cast("string"))
    names = ["name", "passed", "value"]
    checks = F.array(
        _rec(names, "record_count", total > 0, F.concat(total.cast("string"), F.lit(" rows"))),
        _rec(names, "primary_key", (total > 0) & (has_id == total), ratio(has_id)),
        _rec(names, "schema_not_empty", (total > 0) & (has_data == total), ratio(has_data)),
        _rec(names, "null_threshold", (total > 0) & ((null_safe / total) >= F.lit(NULL_SAFE_SHARE)),
             ratio(null_safe)),
    )
    return s.select(F.inline(checks))


def quality_score(checks: DataFrame) -> DataFrame:
    """DQ5 + DQ6: score = round(100 × passed / total); strict gate at ≥ 90."""
    passed = F.count_if(F.col("passed"))
    total = F.count(F.lit(1))
    score = F.bround(passed * 100.0 / total).cast("int")
    return checks.agg(score.alias("quality_score"), total.alias("checks_total"),
                      passed.alias("checks_passed")).withColumn(
        "strict_gate", F.col("quality_score") >= F.lit(STRICT_GATE_SCORE))


def assert_quality(score: DataFrame, minimum_score: int = DEFAULT_MIN_SCORE) -> int:
    """DQ7: raise when the score is below ``minimum_score``; returns the score.

    One ``first()`` of a one-row aggregate: the only driver round trip.
    """
    value = int(score.select("quality_score").first()[0] or 0)
    if value < minimum_score:
        raise QualityGateError(f"Quality score {value} < {minimum_score}")
    return value


def expectations(df: DataFrame, id_col: str = "id") -> DataFrame:
    """DQ8-DQ12: the raw-zone expectation suite and its overall success.

    Rows: (expectation, column, success, observed).  The id checks only run
    when the id column exists, as in the source suite.
    """
    has_id = id_col in df.columns
    aggs = [F.count(F.lit(1)).alias("rows")]
    if has_id:
        aggs += [F.count_if(F.col(id_col).isNull()).alias("null_ids"),
                 (F.count(F.col(id_col)) - F.count_distinct(F.col(id_col))).alias("duplicate_ids")]
    s = df.agg(*aggs)
    n_cols = len(df.columns)
    names = ["expectation", "column", "success", "observed"]
    no_column = F.lit(None).cast("string")
    checks = [("expect_table_row_count_to_be_between", no_column, F.col("rows") >= 1,
               F.col("rows").cast("string"))]
    if has_id:
        checks += [
            ("expect_column_values_to_not_be_null", F.lit(id_col).cast("string"),
             F.col("null_ids") == 0, F.col("null_ids").cast("string")),
            ("expect_column_values_to_be_unique", F.lit(id_col).cast("string"),
             F.col("duplicate_ids") == 0, F.col("duplicate_ids").cast("string")),
        ]
    checks.append(("expect_table_column_count_to_be_between", no_column, F.lit(n_cols >= 2),
                   F.lit(str(n_cols))))
    # The suite summary is built from the same one-row aggregate: one scan.
    all_ok = checks[0][2]
    for item in checks[1:]:
        all_ok = all_ok & item[2]
    n_ok = sum((F.when(item[2], 1).otherwise(0) for item in checks), F.lit(0))
    suite = ("suite", no_column, all_ok,
             F.concat(n_ok.cast("string"), F.lit("/"), F.lit(str(len(checks)))))
    return s.select(F.inline(F.array(*[_rec(names, *item) for item in [*checks, suite]])))


def duplicate_keys(df: DataFrame, id_col: str = "id") -> DataFrame:
    """DQ10 detail: the offending keys with their row counts (group + having)."""
    return (df.where(F.col(id_col).isNotNull()).groupBy(id_col)
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))


def not_null_tests(df: DataFrame, columns=NOT_NULL_COLUMNS) -> DataFrame:
    """DQ13: failures per not-null model test, one aggregate for all columns."""
    s = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    names = ["column", "test", "failures", "passed"]
    return s.select(F.inline(F.array(*[_rec(names, c, "not_null", F.col(c), F.col(c) == 0) for c in columns])))
