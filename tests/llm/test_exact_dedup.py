import hashlib
from collections import defaultdict

import pytest

from tidemark.llm import exact_dedup as ed
from tests.llm.conftest import hostile_rows


def expected():
    groups = defaultdict(list)
    for row in hostile_rows():
        groups[row[1] or ""].append(row[0])
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_matches_brute_force(hostile):
    want = expected()
    got = ed.find_copies(hostile, bucket_bytes=2_000).collect()  # a small bucket: spills several levels deep
    assert len(got) == len(hostile_rows())
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_digest[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)


def test_drop_copies_leaves_one_row_of_each_text(hostile):
    left = ed.drop_copies(hostile)
    assert left.columns == hostile.columns
    assert sorted(r.text or "" for r in left.collect()) == sorted(expected())


def test_empty(nothing):
    assert ed.find_copies(nothing).collect() == [] and ed.drop_copies(nothing).collect() == []


def _record(key, doc_id, text):
    return key, doc_id, 1, 1, text, hashlib.sha256(text).digest()


def test_equal_hashes_of_different_texts_stay_apart():
    texts = [b"x%d" % (k % 50) for k in range(500)]
    found = list(ed.grace((_record(42, k, t) for k, t in enumerate(texts)), bucket_bytes=100))
    assert {r[4]: (r[1], r[2]) for r in found} == {b"x%d" % k: (450 + k, 10) for k in range(50)}


def test_digest_collision_is_an_error():
    table = ed.TextTable()
    table.add((5, 1, 1, 1, b"a", b"d" * 32))
    with pytest.raises(ValueError):
        table.add((5, 2, 1, 1, b"b", b"d" * 32))


def test_spill_files_are_removed(tmp_path, monkeypatch):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    records = [_record(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1, k, b"t%d" % k) for k in range(200)]
    assert len(list(ed.grace(records, bucket_bytes=3_000))) == 200
    assert list(tmp_path.iterdir()) == []
