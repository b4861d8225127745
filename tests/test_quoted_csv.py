import csv
import io
import os
import random

import pytest

from tidemark.plans import runner
from tidemark.schema import RunRequest
from tidemark.session import stored
from tidemark.sources import csv_report as csvr
from tidemark.sources import quoted_csv
from tidemark.sources.ordinal import ROW_NUMBER
from tidemark.sources.quoted_csv import has_quoted_breaks, read_quoted_csv

CELLS = ["", "plain", "with;separator", 'say "hi"', "two\nlines", "dos\r\nbreak", "\n\n", '"', '";\n"', "  padded ", "x" * 300 + "\n" + "y;" * 200,
         "п\nривет", "a\n\n\nb", "\n".join(["long"] * 400)]


def write(folder, name, rows, *, bom=False, end="\r\n", tail=""):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator=end).writerows(rows)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(out.getvalue() + tail)
    return path


def random_rows(seed, n, columns=4):
    rng = random.Random(seed)
    return [["id", "b", "c d", "e.f'"][:columns]] + [[str(k)] + [rng.choice(CELLS) for _ in range(columns - 1)] for k in range(n)]


def reference(paths):
    """The records of all files in path order, by the standard reader."""
    out = []
    for path in sorted(paths):
        with open(path, encoding="utf-8-sig", newline="") as f:
            rows = [r for r in csv.reader(f, delimiter=";") if r]
        out += [[c or None for c in r] for r in rows[1:]]
    return out


def read(spark, folder, split):
    df = read_quoted_csv(spark, folder, split_bytes=split)
    rows = sorted(df.collect(), key=lambda r: r[ROW_NUMBER])
    assert [r[ROW_NUMBER] for r in rows] == list(range(1, len(rows) + 1))
    return df.columns[:-1], [list(r)[:-1] for r in rows]


@pytest.mark.parametrize("split", [64, 1_000, 4_000, None])
def test_many_splits_equal_the_standard_reader(spark, scratch, split):
    paths = [write(scratch, "a.csv", random_rows(1, 60), bom=True), write(scratch, "b.csv", random_rows(2, 60), end="\n"),
             write(scratch, "c.csv", random_rows(3, 1), tail="\n\r\n\n")]
    assert has_quoted_breaks(spark, scratch)
    columns, rows = read(spark, scratch, split)
    assert columns == ["id", "b", "c d", "e.f'"]
    assert rows == reference(paths)


def test_one_record_over_many_splits(spark, scratch):
    big = "\n".join(f"line {k};" for k in range(3_000))
    path = write(scratch, "big.csv", [["id", "b"], ["1", big], ["2", "after"], ["3", big + '"'], ["4", ""]], end="\n")
    lines = spark.read.option("lineSep", "\n").text(path)
    assert read(spark, scratch, 2_000)[1] == reference([path])
    assert lines.count() > 6_000


def test_small_splits_share_tasks(spark, scratch, monkeypatch):
    """Tasks and stored lines do not grow with the number of splits; a record is joined before it is shuffled."""
    paths = [write(scratch, "a.csv", random_rows(4, 300)), write(scratch, "b.csv", random_rows(5, 300), end="\n")]
    lines = quoted_csv.scan_lines(spark, scratch, split_bytes=500)
    splits = lines.select("_file", "_block").distinct().count()
    assert splits > 100
    assert len(lines.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism < splits
    kept = []
    monkeypatch.setattr(quoted_csv, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1])
    assert read(spark, scratch, None)[1] == reference(paths)
    assert kept[0].count() < 700  # 600 records of far more lines


def test_stray_quotes_are_text(spark, scratch):
    """A quote inside a cell that does not start with one opens nothing."""
    path = os.path.join(scratch, "q.csv")
    with open(path, "w", newline="") as f:
        f.write('id;b\n1;5" pipe\n2;"two\nlines"\n3;6" and 7"; "\n4;"a"b;x\n')
    for split in (4, 10, None):
        assert [r[:2] for r in read(spark, scratch, split)[1]] == [["1", '5" pipe'], ["2", "two\nlines"], ["3", '6" and 7"'], ["4", '"a"b']]


def test_header_over_two_lines_and_ragged_records(spark, scratch):
    path = os.path.join(scratch, "r.csv")
    with open(path, "w", newline="") as f:
        f.write('id;"two\nlines";\n1;x;y;surplus\n2\n3;"\n"\n')
    columns, rows = read(spark, scratch, 5)
    assert columns == ["id", "two\nlines", "_c2"]
    assert rows == [["1", "x", "y"], ["2", None, None], ["3", "\n", None]]


def test_unclosed_cell_is_an_error(spark, scratch):
    with open(os.path.join(scratch, "u.csv"), "w") as f:
        f.write('id;b\n1;"open\n2;x\n')
    with pytest.raises(ValueError, match="never closed"):
        read_quoted_csv(spark, scratch)


def test_empty_and_header_only_files(spark, scratch):
    open(os.path.join(scratch, "a.csv"), "w").close()
    write(scratch, "b.csv", [["id", "b"]])
    assert read(spark, scratch, None) == (["id", "b"], [])


def test_plain_reports_keep_the_plain_reader(spark, scratch):
    write(scratch, "p.csv", [["inn", "g1"], ["1", "say \"hi\""], ["2", "a;b"]])
    assert not has_quoted_breaks(spark, scratch)
    assert csvr.load_report(spark, scratch).count() == 2


def test_run_reads_breaks_in_cells(spark, scratch):
    """A run over cells with line breaks keeps every record whole, with its ordinal and types."""
    rows = [["inn", "section", "status", "g1", "g3"]] + [[f"{k:09d}", "S", "ok", str(k), f"firm {k}\n\"branch\"; {k}"] for k in range(1, 41)]
    path = write(scratch, "in.csv", rows)
    result = runner.run(spark, RunRequest(source="products"), input_path=path, root=f"{scratch}/root")
    assert (result.status, result.records) == ("done", 40)
    got = {r["inn"]: (r["g1"], r["g3"], r[ROW_NUMBER], r["id"]) for r in result.prepared.collect()}
    assert got == {f"{k:09d}": (k, f"firm {k}\n\"branch\"; {k}", k, f"{k:09d}:{k}") for k in range(1, 41)}
