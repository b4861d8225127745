import pytest

from tidemark.operators import quality as dq


def test_checks_and_score(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "", None), (3, "c", 1.0)], "id long, s string, x double")
    checks = {r["name"]: (r["passed"], r["value"]) for r in dq.quality_checks(df).collect()}
    assert checks["record_count"] == (True, "3 rows")
    assert checks["primary_key"] == (False, "2/3")
    assert checks["schema_not_empty"] == (True, "3/3")
    assert checks["null_threshold"] == (False, "2/3")
    score = dq.quality_score(dq.quality_checks(df)).first()
    assert score["quality_score"] == 50 and score["strict_gate"] is False
    with pytest.raises(dq.QualityGateError):
        dq.assert_quality(dq.quality_score(dq.quality_checks(df)), 100)
    assert dq.assert_quality(dq.quality_score(dq.quality_checks(df)), 50) == 50


def test_expectations_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id long, s string")
    e = {r["expectation"]: r["success"] for r in dq.expectations(df).collect()}
    assert e["expect_column_values_to_not_be_null"] is False
    assert e["expect_column_values_to_be_unique"] is False
    assert e["suite"] is False
    assert [(r["id"], r["rows"]) for r in dq.duplicate_keys(df).collect()] == [(1, 2)]


def test_not_null_tests(spark):
    df = spark.createDataFrame([("a", "r", "s", None)],
                               "dw_id string, run_id string, source_entity string, metric_value double")
    got = {r["column"]: r["failures"] for r in dq.not_null_tests(df).collect()}
    assert got == {"dw_id": 0, "run_id": 0, "source_entity": 0, "metric_value": 1}
