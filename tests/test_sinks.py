import datetime as dt
import hashlib
import json
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.curate import curate
from tidemark.plans.curate_job import curate_to_parquet, read_raw_records
from tidemark.schema import CURATED_COLUMNS, CURATED_SCHEMA, RUN_AUDIT_SCHEMA
from tidemark.sinks import warehouse as wh
from tidemark.sinks.landing import read_manifest, verify_landing

T0 = dt.datetime(2024, 1, 1)


def _curated(spark, n=4, run="r1"):
    raw = spark.range(n).select(F.col("id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
                                (F.col("id") * 1.5).alias("price"))
    return curate(raw, source_id="products", source_title="P", mode="batch", run_id=run, loaded_at=T0)


def test_zone_roundtrip_overwrites_only_its_run(spark, scratch):
    root = os.path.join(scratch, "root")
    wh.write_zone(_curated(spark, 3, "a"), root, "curated", "products", "a")
    wh.write_zone(_curated(spark, 5, "b"), root, "curated", "products", "b")
    wh.write_zone(_curated(spark, 2, "a"), root, "curated", "products", "a")    # rerun of a
    assert wh.read_zone(spark, root, "curated", "products", "a").count() == 2
    back = wh.read_zone(spark, root, "curated", "products", "b")
    assert back.count() == 5 and set(back.columns) == set(CURATED_COLUMNS)


def test_append_table_and_mart(spark, scratch):
    root = os.path.join(scratch, "root")
    assert wh.append_curated(_curated(spark, 4, "r1"), root) == 4
    assert wh.append_curated(_curated(spark, 3, "r2"), root) == 3
    wh.create_curated_table(spark, root, name="curated_events_test")
    assert spark.sql("SELECT count(*) FROM curated_events_test").first()[0] == 7
    table = wh.read_curated(spark, root)
    assert table.columns == CURATED_COLUMNS
    assert marts.run_check(table, "r2").first()["records"] == 3
    assert marts.run_check(table, "nope").first().asDict() == {"records": 0, "metric_sum": 0.0, "source_count": 0}
    mart_path = wh.write_mart(marts.daily_metrics(table), root)
    assert spark.read.parquet(mart_path).first()["record_count"] == 7


def test_audit_is_append_only_and_concurrent_runs_keep_their_rows(spark, scratch):
    root = os.path.join(scratch, "root")
    assert wh.read_runs(spark, root) is None
    later = T0 + dt.timedelta(hours=1)
    rows = [(f"r{k}", "s", "batch", "done", k, 100, [], T0, T0) for k in range(6)]
    with ThreadPoolExecutor(6) as pool:  # runs that end together
        list(pool.map(lambda row: wh.append_run(spark, row, root), rows))
    wh.append_run(spark, ("r1", "other", "stream", "warning", 2, 75, ["w"], later, later), root)
    got = {r["run_id"]: (r["source"], r["mode"], r["status"], r["records"], r["created_at"]) for r in wh.read_runs(spark, root).collect()}
    assert len(got) == 6 and got["r1"] == ("s", "batch", "warning", 2, T0) and got["r5"][3] == 5


def test_landing_keeps_every_byte(spark, scratch):
    path = os.path.join(scratch, "in.csv")
    data = "\ufeffa;b\r\n1;\"x\ny\"\r\nlast;no newline".encode()
    with open(path, "wb") as f:
        f.write(data)
    for _ in range(2):  # a rerun replaces
        out = wh.write_landing(spark, path, os.path.join(scratch, "root"), "products", "r")
    files = [n for n in os.listdir(out) if not n.startswith(("_", "."))]
    assert len(files) == 1 and open(os.path.join(out, files[0]), "rb").read() == data


def test_landing_manifest_tells_every_file(spark, scratch):
    source, root = os.path.join(scratch, "in put", "deep"), os.path.join(scratch, "root")
    os.makedirs(source)
    contents = {f"{k}.bin": bytes((k * j) % 256 for j in range(k * 997)) for k in range(1, 9)}
    for name, data in contents.items():
        with open(os.path.join(source, name), "wb") as f:
            f.write(data)
    open(os.path.join(source, "_skipped"), "w").close()
    out = wh.write_landing(spark, os.path.dirname(source), root, "s", "r")
    manifest = sorted(read_manifest(spark, out).collect())
    assert [(r["number"], r["name"], r["bytes"], r["sha256"]) for r in manifest] == [
        (k - 1, f"{k - 1:06d}-{k}.bin", len(contents[f"{k}.bin"]), hashlib.sha256(contents[f"{k}.bin"]).hexdigest()) for k in range(1, 9)]
    for r in manifest:
        assert open(os.path.join(out, r["name"]), "rb").read() == contents[r["name"][7:]]
    assert all(r["intact"] for r in verify_landing(spark, out).collect())
    with open(os.path.join(out, "000002-3.bin"), "r+b") as f:
        f.write(b"changed")
    os.remove(os.path.join(out, "000004-5.bin"))
    os.remove(os.path.join(out, ".000002-3.bin.crc")) if os.path.exists(os.path.join(out, ".000002-3.bin.crc")) else None
    assert sorted(r["name"][7] for r in verify_landing(spark, out).collect() if not r["intact"]) == ["3", "5"]
    assert os.listdir(os.path.dirname(out)) == ["run_id=r"]  # no staging folder is left


def test_landing_of_an_empty_folder(spark, scratch):
    os.makedirs(os.path.join(scratch, "none"))
    out = wh.write_landing(spark, os.path.join(scratch, "none"), os.path.join(scratch, "root"), "s", "r")
    assert read_manifest(spark, out).count() == 0


def test_a_retried_run_replaces_its_first_try(spark, scratch):
    root = os.path.join(scratch, "root")

    def runs():
        return {(r["run_id"], r["n"]) for r in wh.read_curated(spark, root).groupBy("run_id").agg(F.count("*").alias("n")).collect()}

    assert wh.append_curated(_curated(spark, 4, "a"), root, run_id="a") == 4
    wh.append_curated(_curated(spark, 6, "b"), root, run_id="b")
    assert wh.append_curated(_curated(spark, 3, "a"), root, run_id="a") == 3
    assert runs() == {("a", 3), ("b", 6)}
    for _ in range(2):
        wh.append_curated(_curated(spark, 2, "c"), root)  # no run id: a bag union
    assert runs() == {("a", 3), ("b", 6), ("c", 4)}
    wh.compact_curated(spark, root, "products")
    assert runs() == {("a", 3), ("b", 6), ("c", 4)}
    wh.append_curated(_curated(spark, 5, "b"), root, run_id="b")  # its first try is in a compacted file
    assert runs() == {("a", 3), ("b", 5), ("c", 4)}
    assert not os.listdir(os.path.join(wh.curated_table_path(root), "_staging"))


def test_a_run_alone_in_a_compacted_source_is_replaced(spark, scratch):
    root = os.path.join(scratch, "root")
    wh.append_curated(_curated(spark, 4, "a"), root, run_id="a")
    wh.compact_curated(spark, root, "products")
    wh.append_curated(_curated(spark, 2, "a"), root, run_id="a")
    assert wh.read_curated(spark, root).count() == 2


def test_compaction_keeps_rows(spark, scratch):
    root = os.path.join(scratch, "root")
    for k in range(4):
        wh.append_curated(_curated(spark, 3, f"r{k}"), root)
    entity = wh.read_curated(spark, root).first()["source_entity"]
    wh.compact_curated(spark, root, entity)
    folder = os.path.join(wh.curated_table_path(root), f"source_entity={entity}")
    assert wh.read_curated(spark, root).count() == 12
    assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) == 1


def test_exports(spark, scratch):
    out = wh.export_version(_curated(spark, 3), os.path.join(scratch, "export"),
                            {"run_id": "r1", "version_id": "prep:x:v1", "stage": "prepared"})
    manifest = json.loads(spark.read.text(out + "/manifest").first()[0])
    assert manifest["record_count"] == 3 and manifest["version_id"] == "prep:x:v1"
    assert spark.read.json(out + "/data").count() == 3
    checks = spark.createDataFrame([("record_count", True, "3 rows")], "name string, passed boolean, value string")
    assert spark.read.json(wh.write_report(checks, os.path.join(scratch, "report"))).count() == 1


def test_batch_curate_job(spark, scratch):
    src = os.path.join(scratch, "raw.json")
    with open(src, "w") as f:
        json.dump({"users": [{"id": 1, "firstName": "A", "age": 3}, {"firstName": "B", "email": "b@x"}]}, f)
    raw = read_raw_records(spark, src, layout="document", collection="users")
    n = curate_to_parquet(spark, raw, os.path.join(scratch, "out"), source="users", run_id="r9", loaded_at=T0)
    got = {r["dw_id"]: r for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
    assert n == 2 and set(got) == {"users_1", "users_2"}
    assert got["users_2"]["status"] == "verified" and got["users_1"]["metric_value"] == 3.0


def test_display_columns_and_internal_drop(spark):
    assert marts.display_columns(["z", "title", "id"], "raw") == ["id", "title", "z"]
    assert marts.display_columns([], "curated") == ["dw_id", "entity_name", "metric_value", "status"]
    df = spark.createDataFrame([(1, "x")], "a long, __v string")
    assert marts.drop_internal(df).columns == ["a"]


def test_sample_rows_in_stored_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "pos long, v string")
    assert [r["v"] for r in marts.sample_rows(df, "pos", 2).collect()] == ["a", "b"]


def test_rows_of_a_run_from_one_task_meet_in_several_files(spark, scratch):
    """A hot run is split between the pieces of map tasks; one map task's rows are several pieces."""
    rows = spark.range(40_000).coalesce(1).select(
        *[(F.concat(F.lit("x_"), F.sha2(F.col("id").cast("string"), 256)) if f.name == "dw_id" else F.lit("posts" if f.name == "source_entity" else "r")
           if f.dataType.simpleString() == "string" else F.lit(None).cast(f.dataType)).alias(f.name) for f in CURATED_SCHEMA.fields])
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "262144")
    try:
        assert wh.append_curated(rows, scratch) == 40_000
    finally:
        spark.conf.set(name, before)
    table = wh.read_curated(spark, scratch)
    assert table.count() == 40_000 == table.select("dw_id").distinct().count()
    assert len(table.inputFiles()) > 1
