import json
import os

from tidemark.sources import csv_report as csvr
from tidemark.sources import payload as pl
from tidemark.sources.ordinal import with_row_number


def test_report_csv_bom_typing_and_row_numbers(spark, scratch):
    d = os.path.join(scratch, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8-sig") as f:
        f.write('inn;g1;g2;g3;g4\n0012;5;1,5;"x;y";7\n;  ;2;a;n/a\n')
    with open(os.path.join(d, "b.csv"), "w", encoding="utf-8") as f:
        f.write("inn;g1;g2;g3;g4\n0013;-3;4.25;b;8\n")
    rows = csvr.load_report(spark, d)
    assert rows.columns[0] == "inn"                    # the BOM does not leak into the header
    types = dict(rows.dtypes)
    assert types["inn"] == "string" and types["g1"] == "bigint" and types["g2"] == "double"
    assert types["g4"] == "string"
    got = sorted((r["_row_number"], r["id"], r["g1"], r["g2"], r["g3"]) for r in rows.collect())
    assert got == [(1, "0012:1", 5, 1.5, "x;y"), (2, "unknown:2", None, 2.0, "a"), (3, "0013:3", -3, 4.25, "b")]
    page = csvr.report_page(rows, skip=1, limit=500).collect()
    assert sorted(r["_row_number"] for r in page) == [2, 3]
    stats = csvr.page_stats(rows, ["inn", "g1", "g2", "g3", "g4"], page_size=2).orderBy("page").collect()
    assert [(r["rows"], r["null_cells"], r["organizations"]) for r in stats] == [(2, 2, 1), (1, 0, 1)]


def test_row_numbers_follow_files_and_blocks(spark, scratch):
    d = os.path.join(scratch, "lines")
    os.makedirs(d)
    for name, start in (("p1.txt", 0), ("p2.txt", 1000)):
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(str(start + i) for i in range(1000)) + "\n")
    df = spark.read.option("maxPartitionBytes", 1024).text(d)
    got = sorted((r["_row_number"], int(r["value"])) for r in with_row_number(df).collect())
    assert [n for n, _ in got] == list(range(1, 2001))
    assert all(v == n - 1 for n, v in got)


def test_payload_unwrap_shapes(spark, scratch):
    obj = os.path.join(scratch, "obj.json")
    arr = os.path.join(scratch, "arr.json")
    with open(obj, "w") as f:
        json.dump({"users": [{"id": 1, "a": "x"}, {"id": 2, "a": None}], "total": 2}, f, indent=2)
    with open(arr, "w") as f:
        json.dump([{"id": 7}, {"id": 8}], f)
    p = pl.read_payloads(spark, obj, layout="document")
    assert sorted(r["id"] for r in pl.unwrap(p, "users").collect()) == [1, 2]
    assert pl.unwrap(p, "carts").count() == 0
    a = pl.read_payload_text(spark, arr, layout="document")
    assert sorted(r["id"] for r in pl.parse_records(pl.unwrap_text(a, "users")).collect()) == [7, 8]
    s = pl.payload_summary(pl.read_payload_text(spark, obj, layout="document"), "users").first()
    assert s["kind"] == "object" and s["top_level_keys"] == "users,total" and s["records"] == 2


def test_union_ragged(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, 3.5), (2, 3.5)], "id long, b double")
    got = sorted(tuple(r) for r in pl.union_ragged(a, b).select("id", "a", "b").collect())
    assert got == [(1, "x", None), (2, None, 3.5), (2, None, 3.5)]


def test_each_payload_is_decided_on_its_own(spark, scratch):
    path = os.path.join(scratch, "mixed.json")
    with open(path, "w") as f:
        f.write('\n[{"id": 1}, {"id": 2, "x": {"y": 1}}]\n{"users": [{"id": 3}], "total": 1}\n{"users": 4}\n{"other": []}\n[{"id": 4\n[]\n')
    text = pl.read_payload_text(spark, path)
    rows = pl.parse_records(pl.unwrap_text(text, "users"))
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    assert sorted(r["records"] for r in pl.payload_count(text, "users").collect()) == [0, 0, 0, 0, 0, 1, 2]
