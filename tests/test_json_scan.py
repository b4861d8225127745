import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import runner
from tidemark.schema import RunRequest
from tidemark.session import shared_path
from tidemark.sources import json_scan
from tidemark.sources import payload as pl
from tidemark.sources.ordinal import ROW_NUMBER

STRINGS = ["", "plain", "}", "]}", '"', '\\', '\\"}', "a\\\\", "{[", "], [", '","', "line\nbreak", "é中", " ", "users", '"users": [']


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return rng.choice(STRINGS)
    if kind == 2:
        return rng.choice([None, True, False, 0, -1.5, 1e300])
    if kind == 3:
        return rng.randrange(10**12)
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(STRINGS) + str(k): value(rng, depth + 1) for k in range(rng.randrange(4))}


def documents(seed):
    rng = random.Random(seed)
    records = lambda n: [{"id": k, "x": value(rng), "users": [{"id": "inner"}]} for k in range(n)]
    return [
        ("array", json.dumps(records(40))),
        ("array_pretty", "﻿\n " + json.dumps(records(25), indent=2, ensure_ascii=False) + "\n\n"),
        ("object", json.dumps({"total": 3, "meta": {"users": [1, {"a": {"b": []}}], "z": {}}, "others": records(9), "users": records(30), "after": records(7)})),
        ("object_pretty", json.dumps({"users": records(12), "limit": "}"}, indent=1, ensure_ascii=False)),
        ("mixed_elements", json.dumps([{"id": 1}, 3, "te}xt", None, [1, {"a": 2}], {}, []])),
        ("nothing", json.dumps({"others": records(5), "users": {"users": [{"id": 1}]}})),
        ("empty_array", "[ \n ]"), ("empty_collection", '{"users": [  ], "x": [{}]}'), ("blank", "\n  \n"), ("scalar", '"users"'),
        ("cut_short", json.dumps(records(6))[:-1]), ("cut_in_record", json.dumps({"users": records(6)})[:-30]),
        ("long", json.dumps({"users": [{"id": 1, "t": "}" * 5_000}, {"id": 2, "t": [[{}] * 700]}, {"id": 3}]}))]


def expected(text):
    try:
        payload = json.loads(text.lstrip("﻿"))
    except ValueError:
        return []
    rows = payload if isinstance(payload, list) else payload.get("users") if isinstance(payload, dict) else []
    return rows if isinstance(rows, list) else []


def land(folder, seed):
    want = []
    for name, text in sorted(documents(seed)):
        with open(os.path.join(folder, f"{name}.json"), "w", encoding="utf-8") as f:
            f.write(text)
        want += expected(text)
    return want


@pytest.mark.parametrize("seed, size", [(1, 40), (2, 333), (3, 3_000), (4, 1 << 20)])
def test_records_by_ranges_equal_a_json_parser(spark, scratch, seed, size):
    want = land(scratch, seed)
    rows = sorted(json_scan.read_records(spark, scratch, "users", range_bytes=size).collect(), key=lambda r: r[ROW_NUMBER])
    assert [r[ROW_NUMBER] for r in rows] == list(range(1, len(want) + 1))
    assert [json.loads(r["record"]) for r in rows] == want


def test_sorted_way_equals_the_broadcast_one(spark, scratch, monkeypatch):
    want = land(scratch, 5)
    monkeypatch.setattr(json_scan, "BROADCAST_RANGES", 0)
    rows = sorted(json_scan.read_records(spark, scratch, "users", range_bytes=500).collect(), key=lambda r: r[ROW_NUMBER])
    assert [json.loads(r["record"]) for r in rows] == want


def test_large_and_small_documents_give_the_same_rows(spark, scratch):
    land(scratch, 6)
    small = pl.document_records(spark, scratch, "users")
    large = pl.document_records(spark, scratch, "users", scan_from=0)
    a, b = ({r[ROW_NUMBER]: json.loads(r["record"]) for r in df.collect() if (r["record"] or "").startswith("{")} for df in (small, large))
    assert len(a) > 80 and a == b


def test_run_over_a_large_document(spark, scratch, monkeypatch):
    records = [{"id": k, "firstName": f"N{k}", "age": k, "company": {"department": "d}"}} for k in range(1, 301)]
    path = os.path.join(scratch, "users.json")
    with open(path, "w") as f:
        json.dump({"total": 300, "users": records}, f)
    monkeypatch.setattr(pl.document_records, "__kwdefaults__", {"scan_from": 1_000})
    result = runner.run(spark, RunRequest(source="users"), input_path=path, root=f"{scratch}/root")
    assert (result.status, result.records) == ("done", 300)
    assert {(r["id"], r[ROW_NUMBER]) for r in result.prepared.collect()} == {(k, k) for k in range(1, 301)}


@pytest.mark.parametrize("seed, size, most", [(1, 40, 50_000), (2, 333, 50_000), (3, 3_000, 0)])
def test_chunks_of_the_spark_reader_equal_a_json_parser(spark, scratch, monkeypatch, seed, size, most):
    want = land(scratch, seed)
    monkeypatch.setattr(json_scan, "_open_to_tasks", lambda spark, files: (False, 0))
    monkeypatch.setattr(json_scan, "BROADCAST_RANGES", most)
    rows = sorted(json_scan.read_records(spark, scratch, "users", range_bytes=size).collect(), key=lambda r: r[ROW_NUMBER])
    assert [json.loads(r["record"]) for r in rows] == want and [r[ROW_NUMBER] for r in rows] == list(range(1, len(want) + 1))


def test_many_ranges_share_a_task_and_no_text_is_stored_or_shuffled(spark, scratch, monkeypatch):
    records = [{"id": k, "t": "}]" * (400 if k % 50 == 0 else 3)} for k in range(1500)]
    for name in "ab":
        with open(os.path.join(scratch, f"{name}.json"), "w") as f:
            json.dump({"users": records}, f)
    size = os.path.getsize(os.path.join(scratch, "a.json"))
    assert size // 64 > 800  # ranges of a file
    stored = []
    monkeypatch.setattr(json_scan, "shared_path", lambda *a, **k: stored.append(a) or shared_path(*a, **k))
    context = spark.sparkContext
    context.setJobGroup("json-ranges", "")
    try:
        got = json_scan.read_records(spark, scratch, "users", range_bytes=64)
        rows = got.agg(F.count("*"), F.sum(ROW_NUMBER), F.max(ROW_NUMBER)).first()
    finally:
        context._jsc.clearJobGroup()
    assert tuple(rows) == (3000, 3000 * 3001 // 2, 3000) and not stored
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("json-ranges") for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and max(tasks) <= max(4 * context.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_ranges_share_out_the_chunks_of_a_file_at_any_block_size():
    _, pieces, runs = json_scan._reader()
    rng = random.Random(7)
    for _ in range(60):
        data = "".join(rng.choice("{}}x\u00e9\n") for _ in range(rng.randrange(1, 80))).encode()
        size, width, most, step = len(data), rng.randrange(1, 30), rng.randrange(1, 9), rng.randrange(1, 9)
        read = lambda at, n: data[at: at + n]
        shares = [list(pieces(read, start, start + width, size, most, step)) for start in range(0, size, width)]
        assert b"".join(p for share in shares for p, own in share if own) == data
        for start, share in zip(range(0, size, width), shares):
            whole = b"".join(p for p, _ in share)
            assert not share or data.endswith(whole) and start <= size - len(whole) < start + width
            assert all(p.endswith(b"}") for p, _ in share[:-1])

    text = json.dumps({"meta": [1], "users": [7, {"a": 'q"}\\\\'}, [], "}", [{"b": "]," * 20}, 2], None, {}]}, indent=1).encode()
    for width in (3, 11, 1000):
        for most in (1, 5, 1 << 20):
            found, inside, depth, wanted = [], 0, 0, False
            for start in range(0, len(text), width):
                share = list(pieces(lambda at, n: text[at: at + n], start, start + width, len(text), most, 2))
                for kind, own, *rest in runs(iter(share), 2, depth, inside, wanted, "users"):
                    if kind == "container":
                        wanted = own
                    else:
                        found += [rest[0][a:b].strip() for a, b in zip(rest[1].tolist(), rest[2].tolist())]
                for piece, own in share:
                    if own:
                        for k, byte in enumerate(piece):
                            escaped = (len(piece[:k]) - len(piece[:k].rstrip(b"\\"))) % 2
                            inside ^= byte == 34 and not escaped
                            depth += 0 if inside else (byte in b"{[") - (byte in b"]}")
            assert [json.loads(f) for f in found] == json.loads(text)["users"]


def test_records_of_bytes_that_are_no_utf8_and_of_compressed_files(spark, scratch):
    with open(os.path.join(scratch, "a.json"), "wb") as f:
        f.write(b'[{"id": 1, "t": "\xff}"}, \x0b{"id": 2}]')
    rows = json_scan.read_records(spark, scratch, "users", range_bytes=8).orderBy(ROW_NUMBER).collect()
    assert [json.loads(r["record"]) for r in rows] == [{"id": 1, "t": "\ufffd}"}, {"id": 2}]
    files = spark.createDataFrame([("file:/x/a.json.gz", 5)], "path string, _size long")
    assert json_scan._open_to_tasks(spark, files) == (False, 5)
    assert json_scan._open_to_tasks(spark, files.select(F.lit("odd://x/a.json").alias("path"), "_size")) == (False, 5)
