import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators import lineage as lin


def test_field_diff_states(spark):
    before = spark.createDataFrame([(1, "a", {"w": 1.0}, 5), (2, "b", {"w": None}, 6)],
                                   "id long, s string, d struct<w:double>, gone long")
    after = spark.createDataFrame([(1, "a", {"w": 2.0}, "x"), (3, "c", {"w": 1.0}, "y")],
                                  "id long, s string, d struct<w:double>, new string")
    got = {(r["id"], r["field"]): r["state"] for r in lin.field_diff(before, after).collect()}
    assert got[(1, "s")] == "same" and got[(1, "d.w")] == "changed"
    assert got[(1, "gone")] == "removed" and got[(1, "new")] == "added"
    assert got[(2, "s")] == "removed" and got[(3, "s")] == "added"


def test_versions(spark):
    runs = spark.createDataFrame([("abcdef123456", "users"), ("r2", "we!rd name")], "run_id string, source string")
    v = {r["source"]: r.asDict() for r in lin.dataset_versions(runs).collect()}
    assert v["users"]["file_id"] == "FILE-ABCDEF12" and v["users"]["file_name"] == "siat-users.json"
    assert v["we!rd name"]["raw_version"] == "raw:werdname:v0"
    rows = spark.createDataFrame([("a/b-123456789", 1), (None, 2)], "dw_id string, pos long")
    rv = {r["pos"]: r["raw_version"] for r in lin.record_versions(rows, "pos").collect()}
    assert rv[1] == "raw:23456789:v0" and rv[2] == "raw:row-2:v0"


def test_upsert_keeps_created_and_replaces_status(spark):
    schema = ("run_id string, source string, mode string, status string, records long, quality_score int, "
              "warnings array<string>, created_at timestamp, updated_at timestamp")
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    old = spark.createDataFrame([("r1", "s", "batch", "warning", 5, 75, ["w"], t0, t0)], schema)
    new = spark.createDataFrame([("r1", "x", "api", "done", 6, 100, [], t1, t1),
                                 ("r2", "s", "api", "done", 1, 100, [], t1, t1)], schema)
    got = {r["run_id"]: r.asDict() for r in audit.upsert_runs(old, new).collect()}
    assert got["r1"]["source"] == "s" and got["r1"]["mode"] == "batch" and got["r1"]["created_at"] == t0
    assert got["r1"]["status"] == "done" and got["r1"]["records"] == 6 and got["r1"]["updated_at"] == t1
    assert got["r2"]["created_at"] == t1


def test_stage_chain_and_merge(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    stages = audit.stage_rows(spark, [
        {"run_id": "r", "id": sid, "status": st, "sequence": i + 1, "started_at": t, "ended_at": t,
         "duration_ms": 10, "warnings": ["w"] if st != "done" else [], "output_ref": ref}
        for i, (sid, st, ref) in enumerate([("fastapi", "done", "/x"), ("landing", "done", "s3://a"),
                                           ("raw", "warning", "local://b"), ("gx", "error", None)])])
    assert audit.stage_chain(stages).first()["chain"] == "fastapi -> landing -> raw -> gx"
    merged = {r["display_stage"]: r for r in audit.merge_stage_pairs(stages).collect()}
    assert merged["landing"]["status"] == "warning" and merged["landing"]["duration_ms"] == 20
    st = audit.run_status(stages).first()
    assert st["status"] == "error" and st["failed_stage"] == "gx"
    rep = audit.run_report(stages).first()
    assert rep["destinations"] == 2 and rep["stage_duration_ms"] == 40
    counts = stages.select(audit.stage_record_count(stages, F.lit(-1)).alias("n")).collect()
    assert all(r["n"] == -1 for r in counts)


def test_versions_refuse_nothing_and_labels_are_not_cut(spark):
    rows = spark.createDataFrame([(n, "" if n > 9 else f"r{n}") for n in (7, 100, 109)], "_row long, id string")
    got = {r["_row"]: r["raw_version"] for r in lin.record_versions(rows, "_row").collect()}
    assert got == {7: "raw:r7:v0", 100: "raw:100:v0", 109: "raw:109:v0"}
    with pytest.raises(ValueError):
        lin.save_prepared_version(rows, rows.limit(0), "v", ordinal="_row")


def test_repeated_edits_do_not_multiply_lineage(spark):
    raw = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "_row long, id long, v string")
    line = lin.build_lineage(raw, raw, None, source="todos", run_id="r", ordinal="_row")
    edits = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, None, "z")], "_row long, id long, v string")
    out = lin.replace_prepared(line, edits, ordinal="_row").collect()
    assert len(out) == 3
    diff = lin.field_diff(raw, edits, ordinal="_row").collect()
    assert sorted((r["id"] or 0, r["before"], r["after"], r["state"]) for r in diff) == [(0, "c", "z", "changed"), (5, "a", "x", "changed"), (5, "b", "y", "changed")]
