from pyspark.sql import functions as F

from tidemark.operators import prepare as prep

CORR = "seq long, record_id string, column string, value string"


def test_defaults_follow_source_rules(spark):
    df = spark.createDataFrame(
        [(1, 1, 2.675, True, "b", None, None), (2, 2, 1.0, False, "a", None, None),
         (3, None, None, None, "b", None, None), (4, 2, 2.0, None, "a", None, None)],
        "id long, n long, x double, flag boolean, s string, empty string, typed long")
    num, text = prep.column_defaults(df)
    d = num.first().asDict()
    t = text.first().asDict()
    assert d["n"] == 2                      # mean 5/3 -> 2 (half-even)
    assert abs(d["x"] - 1.89) < 1e-9        # mean 5.675/3 -> 1.89
    assert d["flag"] is True                # 1 of 2 true: a tie counts as True
    assert d["typed"] is None               # all-NULL typed column stays NULL (D6)
    assert t["s"] == "a"                    # tie between a and b -> smallest text
    assert t["empty"] == prep.IMPUTED_UNKNOWN


def test_trim_blank_and_profile_counts(spark):
    raw = spark.createDataFrame([(1, " a ", ""), (2, "   ", "b"), (3, "c", None)], "id long, s string, t string")
    p = prep.prepare(raw)
    prof = p.profile.first().asDict()
    assert prof["rows"] == 3 and prof["columns"] == 3
    assert prof["trimmed_values"] == 2      # ' a ' and '   '
    assert prof["blank_to_null"] == 2       # '   ' and ''
    assert prof["imputed_values"] == 3      # s row 2, t rows 1 and 3
    out = {r["id"]: (r["s"], r["t"]) for r in p.rows.collect()}
    assert out[1] == ("a", "b") and out[2] == ("a", "b") and out[3] == ("c", "b")


def test_imputation_log_record_label(spark):
    raw = spark.createDataFrame([(0, None), (5, "x")], "id long, s string")
    log = prep.prepare(raw).imputation_log.collect()
    assert [(r["record_id"], r["column"], r["value"]) for r in log] == [("unknown", "s", "x")]


def test_corrections_order_types_and_rejects(spark):
    raw = spark.createDataFrame([(1, "a", 1.5, 10, True), (2, "b", 2.5, 20, False)],
                                "id long, s string, x double, n long, ok boolean")
    corr = spark.createDataFrame([
        (1, "1", "x", "3.25"), (2, "1", "x", " 4 "), (3, "2", "s", "  "), (4, "9", "x", "1"),
        (5, "2", "nope", "1"), (6, "2", "n", "abc"), (7, "2", "ok", "HA"), (8, "1", "s", None)], CORR)
    p = prep.prepare(raw, corr, id_col="id", ordinal="id")
    rows = {r["id"]: r.asDict() for r in p.rows.collect()}
    assert rows[1]["x"] == 4.0 and rows[1]["s"] is None
    assert rows[2]["s"] is None and rows[2]["ok"] is True and rows[2]["n"] == 20
    audit = {r["seq"]: r.asDict() for r in p.corrections.collect()}
    assert audit[1]["before"] == "1.5" and audit[1]["after"] == "3.25"
    assert audit[2]["before"] == "3.25" and audit[2]["after"] == "4.0"
    assert audit[4]["reason"] == prep.REJECT_NO_RECORD
    assert audit[5]["reason"] == prep.REJECT_NO_COLUMN
    assert audit[6]["reason"] == prep.REJECT_TYPE
    prof = p.profile.first()
    assert prof["manual_corrections_applied"] + prof["manual_corrections_rejected"] == 8
    assert prof["manual_corrections_rejected"] == 3


def test_duplicate_ids_only_last_row_is_corrected(spark):
    raw = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "id long, s string, pos long")
    corr = spark.createDataFrame([(1, "1", "s", "z")], CORR)
    out = sorted((r["pos"], r["s"]) for r in prep.prepare(raw, corr, ordinal="pos").rows.collect())
    assert out == [(1, "a"), (2, "z"), (3, "c")]


def test_laws_idempotent_and_no_nulls(spark):
    raw = spark.createDataFrame([(1, " a", None), (2, None, 3.0), (3, "a ", 5.0)], "id long, s string, x double")
    once = prep.prepare(raw).rows
    twice = prep.prepare(once).rows
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.where(F.col("s").isNull() | F.col("x").isNull()).count() == 0


def test_hot_value_and_hot_duplicate_id(spark):
    """A third of the rows share one value and one id: results stay whole and exact."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 50).cast("string"))).alias("s"),
        F.col("id").alias("pos"))
    corr = spark.createDataFrame([(1, "7", "s", "fixed")], CORR)
    p = prep.prepare(df, corr, ordinal="pos")
    rows = p.rows
    assert rows.count() == n
    assert rows.where(F.col("s").isNull()).count() == 0
    # the mode is the hot value; only the last row of the duplicated id is corrected
    assert p.defaults._where  # defaults were planned
    fixed = rows.where(F.col("s") == "fixed").collect()
    assert [(r["id"], r["pos"]) for r in fixed] == [(7, 2997)]
    assert rows.where(F.col("s") == "hot").count() == n // 3 - 1 + rows.where(
        (F.col("id") != 7) & (F.col("pos") % 5 == 0) & (F.col("pos") % 3 != 0)).count()


def test_nested_columns_imputed_by_json_mode(spark):
    """D6c: a NULL struct/array cell takes the most common value of its column;
    NULLs inside a struct are left alone."""
    df = spark.createDataFrame(
        [(1, {"w": 1.0}, ["a"]), (2, {"w": 1.0}, ["a"]), (3, {"w": None}, None), (4, None, ["b"])],
        "id long, d struct<w:double>, tags array<string>")
    out = {r["id"]: r for r in prep.prepare(df).rows.collect()}
    assert out[4]["d"]["w"] == 1.0
    assert out[3]["tags"] == ["a"]
    assert out[3]["d"]["w"] is None


def test_bround_half_even_means(spark):
    """D2: means round half-even (2.5 → 2, 3.5 → 4)."""
    df = spark.createDataFrame([(1, 2, 3), (2, 3, 4), (3, None, None)], "id long, a long, b long")
    d = prep.column_defaults(df)[0].first()
    assert d["a"] == 2 and d["b"] == 4


def test_hostile_headers_ids_and_corrections(spark):
    """Dots and apostrophes in headers, nested columns, repeated and NULL ids, many rejected corrections of one name."""
    rows = [(k, None if k % 4 == 0 else k % 3, " a " if k % 2 else None, None if k % 5 == 0 else float(k), (k, None)) for k in range(1, 13)]
    df = spark.createDataFrame(rows, "_row long, id long, `o'zgarish nomi` string, `g.1` double, nested struct<x:long,y:string>")
    corr = spark.createDataFrame(
        [(1, "1", "o'zgarish nomi", "b"), (2, "1", "o'zgarish nomi", "c"), (3, "2", "g.1", "7.5"), (4, "2", "g.1", "bad")]
        + [(10 + k, None, "g.1", "1") for k in range(50)] + [(90, "99", "g.1", "1"), (91, "1", "nope", "1")],
        "seq long, record_id string, column string, value string")
    p = prep.prepare(df, corr, ordinal="_row")
    got = {r["_row"]: r for r in p.rows.collect()}
    assert len(got) == 12
    assert got[10]["o'zgarish nomi"] == "c" and got[7]["o'zgarish nomi"] == "a"  # the last row with the id is corrected
    assert got[11]["g.1"] == 7.5 and got[12]["nested"]["x"] == 12
    audit = {r["seq"]: r for r in p.corrections.collect()}
    assert len(audit) == 56 and (audit[1]["before"], audit[2]["before"]) == ("a", "b")
    assert [audit[k]["status"] for k in (1, 2, 3, 4, 10, 90, 91)] == ["applied"] * 3 + ["rejected"] * 4
    assert p.profile.first()["manual_corrections_applied"] == 3
