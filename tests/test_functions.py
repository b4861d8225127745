from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_double_or_zero, blank_to_null, exact_sum, py_strip, py_text, truthy


def test_strip_matches_python_unicode_whitespace(spark):
    samples = ["  a b ", "\ta\n", " x ", "\u0085y ", "\x1cz\x1f", "", "   ", "no"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r[0] for r in df.select(py_strip(F.col("v"))).collect()]
    assert got == [s.strip() for s in samples]


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" ",), ("",), (" a ",), (None,)], "v string")
    assert [r[0] for r in df.select(blank_to_null(F.col("v"))).collect()] == [None, None, "a", None]


def test_truthy_rules(spark):
    df = spark.createDataFrame([("", 0, False, []), ("x", 2, True, ["a"]), (None, None, None, None)],
                               "s string, n long, b boolean, a array<string>")
    rows = df.select(
        truthy(F.col("s"), T.StringType()), truthy(F.col("n"), T.LongType()),
        truthy(F.col("b"), T.BooleanType()), truthy(F.col("a"), T.ArrayType(T.StringType()))).collect()
    assert [tuple(r) for r in rows] == [(False,) * 4, (True,) * 4, (False,) * 4]


def test_py_text_renders_none_and_bools(spark):
    df = spark.createDataFrame([(None, True), (5, False)], "n long, b boolean")
    rows = df.select(py_text(F.col("n"), T.LongType()), py_text(F.col("b"), T.BooleanType())).collect()
    assert [tuple(r) for r in rows] == [("None", "True"), ("5", "False")]


def test_sum_neither_zeroes_drops_nor_aborts(spark):
    nan = float("nan")
    rows = [("tiny", 1e-12), ("tiny", 1e-12), ("huge", 1e30), ("huge", 1.0), ("nan", nan), ("nan", 1.0), ("plain", 0.1), ("plain", 0.2), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got["tiny"] == 2e-12 and got["huge"] == 1e30 and got["nan"] != got["nan"] and got["plain"] == 0.3 and got["none"] is None


def test_text_that_is_no_number_is_not_zero(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("2.5",)], "p string")
    got = [r[0] for r in df.select(as_double_or_zero(F.col("p"), df.schema["p"].dataType)).collect()]
    assert got == [None, 0.0, 0.0, 2.5]
