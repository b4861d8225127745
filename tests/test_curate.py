import datetime as dt

from tidemark.operators.curate import curate
from tidemark.schema import CURATED_COLUMNS

NOW = dt.datetime(2024, 1, 1)


def rows(df):
    return {r["dw_id"]: r.asDict() for r in df.collect()}


def test_products_branch_falsy_rules(spark):
    df = spark.createDataFrame(
        [(1, "A", "c", 0.0, ""), (2, None, None, None, None), (3, "B", "d", 9.5, "In Stock")],
        "id long, title string, category string, price double, availabilityStatus string")
    out = curate(df, source_id="products", source_title="T", mode="batch", run_id="r", loaded_at=NOW)
    assert out.columns == CURATED_COLUMNS
    got = rows(out)
    assert got["products_1"]["metric_value"] == 0.0 and got["products_1"]["status"] == "active"
    assert got["products_2"]["entity_name"] is None and got["products_2"]["metric_value"] == 0.0
    assert got["products_3"]["status"] == "In Stock" and got["products_3"]["metric_name"] == "price"


def test_enterprise_branch_first_numeric_metric(spark):
    df = spark.createDataFrame(
        [("7", None, 5, 2.5, None, "x", "", "s"), ("8", "Org", None, None, 4.0, "y", "A", None),
         ("9", None, None, None, None, "z", None, None)],
        "inn string, g3 string, g1 long, g2 double, g4 double, g5 string, section string, status string")
    out = curate(df.withColumn("id", df.inn), source_id="products", source_title="T", mode="batch",
                 run_id="r", loaded_at=NOW)
    got = rows(out)
    assert (got["products_7"]["metric_name"], got["products_7"]["metric_value"]) == ("g2", 2.5)
    assert got["products_7"]["entity_name"] == "INN 7"
    assert got["products_7"]["category"] == "section_unknown" and got["products_7"]["status"] == "status_s"
    assert (got["products_8"]["metric_name"], got["products_8"]["metric_value"]) == ("g4", 4.0)
    assert got["products_8"]["entity_name"] == "Org" and got["products_8"]["category"] == "section_A"
    assert (got["products_9"]["metric_name"], got["products_9"]["metric_value"]) == ("reported_value", 0.0)


def test_users_branch(spark):
    df = spark.createDataFrame(
        [(1, "Ann", "", {"department": ""}, "admin", 30.0, "a@x"),
         (2, None, "Lee", None, None, None, "")],
        "id long, firstName string, lastName string, company struct<department:string>, role string, "
        "age double, email string")
    got = rows(curate(df, source_id="users", source_title="U", mode="api", run_id="r", loaded_at=NOW))
    assert got["users_1"]["entity_name"] == "Ann" and got["users_1"]["category"] == "admin"
    assert got["users_1"]["status"] == "verified" and got["users_1"]["metric_value"] == 30.0
    assert got["users_2"]["entity_name"] == "Lee" and got["users_2"]["category"] == "user"
    assert got["users_2"]["status"] == "missing_email"


def test_carts_branch_renders_none(spark):
    df = spark.createDataFrame([(1, None, 10.0, 0), (2, 5, None, 3)],
                               "id long, userId long, total double, totalProducts long")
    got = rows(curate(df, source_id="carts", source_title="C", mode="batch", run_id="r", loaded_at=NOW))
    assert got["carts_1"]["category"] == "user_None" and got["carts_1"]["status"] == "0 products"
    assert got["carts_2"]["entity_name"] == "Cart 2" and got["carts_2"]["metric_value"] == 0.0


def test_generic_branch_and_missing_id_uses_position(spark):
    df = spark.createDataFrame(
        [("", "todo", [], 0, {"likes": 0}, True, 1), (None, None, ["t"], 4, {"likes": 7}, False, 2)],
        "title string, todo string, tags array<string>, userId long, reactions struct<likes:long>, "
        "completed boolean, pos long")
    got = rows(curate(df, source_id="todos", source_title="B", mode="batch", run_id="r", loaded_at=NOW,
                      ordinal="pos"))
    assert got["todos_1"]["entity_name"] == "todo" and got["todos_1"]["category"] == "general"
    assert got["todos_1"]["metric_value"] == 1.0 and got["todos_1"]["status"] == "completed"
    assert got["todos_2"]["entity_name"] == "Record None" and got["todos_2"]["category"] == "t"
    assert got["todos_2"]["metric_value"] == 7.0 and got["todos_2"]["status"] == "active"


def test_add_missing_columns_and_registry(spark):
    from pyspark.sql import types as T

    from tidemark.operators.curate import add_missing_columns
    from tidemark.schema import get_source, sources_frame
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("todo", T.StringType()),
                             T.StructField("completed", T.BooleanType())])
    df = add_missing_columns(spark.createDataFrame([(1,)], "id long"), declared)
    assert df.dtypes == [("id", "bigint"), ("todo", "string"), ("completed", "boolean")]
    assert sources_frame(spark).count() == 7
    assert get_source("users").collection == "users"
    import pytest
    with pytest.raises(KeyError):
        get_source("nope")
