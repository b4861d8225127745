import zlib

import numpy as np
import pytest
from pyarrow import fs

from tidemark.llm import token_files as tf
from tests.llm.conftest import hostile_rows
from tests.llm.test_packing import whole_ids


def test_round_trip_in_doc_id_order(spark, hostile, scratch):
    manifest = tf.write_token_files(hostile, f"file://{scratch}/tokens", frame_ids=1_000)
    got = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in tf.read_token_files(spark, manifest).collect())
    source = sorted(hostile_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for row, ids in zip(source, whole_ids([r[1] for r in source])):
        want.append((start, len(ids), row[0], zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_empty(spark, nothing, scratch):
    manifest = tf.write_token_files(nothing, f"{scratch}/none")
    assert tf.read_token_files(spark, manifest).collect() == []


@pytest.fixture()
def one_file(scratch):
    system = fs.LocalFileSystem()
    with system.open_output_stream(f"{scratch}/f") as sink:
        writer = tf.TokenFileWriter(sink, frame_ids=100)
        for k in range(50):
            writer.add(k, np.arange(k * 7, dtype="<u4").tobytes())
        writer.close()
    return system, f"{scratch}/f"


def test_reader_opens_only_the_frames_it_needs(one_file):
    system, path = one_file
    with system.open_input_file(path) as source:
        reader = tf.TokenFileReader(source)
        opened, inner = [], reader.frame
        reader.frame = lambda k: opened.append(k) or inner(k)
        found = reader.read([3, 49])
        assert found[3].tolist() == list(range(21)) and found[49].tolist() == list(range(343))
        assert len(set(opened)) < len(reader.sizes) / 5


def test_any_zstandard_reader_can_decompress(one_file):
    import zstandard

    system, path = one_file
    with open(path, "rb") as source:
        data = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True).read()
    assert data == b"".join(np.arange(k * 7, dtype="<u4").tobytes() for k in range(50))


def test_damage_is_noticed(one_file):
    system, path = one_file
    data = bytearray(open(path, "rb").read())
    data[30] ^= 255
    open(path, "wb").write(data)
    with system.open_input_file(path) as source, pytest.raises(Exception):
        tf.TokenFileReader(source).read(range(50))
