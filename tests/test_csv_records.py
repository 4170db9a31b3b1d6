from __future__ import annotations

import csv
import random

import pytest

from rowan.sources import csv_records
from rowan.sources.tables import csv_options, read_raw


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few lines, a task for each."""
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def cell(draw):
    kinds = ("plain", "", "with, comma", 'with "quotes"', "two\nlines", 'three\n"odd" \n,lines', "crlf\r\ninside", '"',
             "\n", "\n\n", "x" * 150, "long\n" * 60, " padded ", "é汉🙂")
    return draw.choice(kinds)


def write(path, rows, end="\n", header=("id", "a b", "c")):
    with path.open("w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def both(spark, path):
    """Rows as read here and as Spark's reader gives them from one task, and the tasks it took here."""
    got = read_raw(spark, path)
    want = read_raw(spark, path, "csv", {"multiLine": "true"})
    assert got.columns == want.columns
    key = lambda r: repr(tuple(r))
    return sorted(got.collect(), key=key), sorted(want.collect(), key=key), got.rdd.getNumPartitions()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_same_rows_as_from_one_task(spark, small_ranges, tmp_path, seed, end):
    draw = random.Random(seed)
    rows = [(f"r{i:03d}", cell(draw), cell(draw)) for i in range(120)]
    got, want, tasks = both(spark, write(tmp_path / "t.csv", rows, end))
    assert [tuple(r) for r in got] == sorted((tuple(c or None for c in r) for r in rows), key=repr)
    assert tasks > 5
    # Between records that end in CRLF, Spark's reader makes a line feed of one in quotes.
    assert end == "\r\n" or got == want


def test_several_files_each_with_a_header(spark, small_ranges, tmp_path):
    draw = random.Random(7)
    (tmp_path / "in").mkdir()
    for k in range(3):
        rows = [(f"f{k}r{i}", cell(draw), cell(draw)) for i in range(20)]
        write(tmp_path / "in" / f"{k}.csv", rows, header=("id", "two\nlines", "c") if k else ("id", "two\nlines", "c"))
    got, want, _ = both(spark, f"{tmp_path}/in/*.csv")
    assert got == want and len(got) == 60


def test_files_without_broken_records_go_to_the_reader_by_lines(spark, small_ranges, tmp_path, monkeypatch):
    rows = [(f"r{i}", 'a "quoted" one', "x, y") for i in range(60)]
    path = write(tmp_path / "t.csv", rows)
    monkeypatch.setattr(csv_records, "_pieces", None)
    got, want, tasks = both(spark, path)
    assert got == want and len(got) == 60 and tasks > 5


def test_starts_that_are_joined(spark, small_ranges, tmp_path, monkeypatch):
    draw = random.Random(4)
    rows = [(f"r{i}", cell(draw), cell(draw)) for i in range(40)]
    monkeypatch.setattr(csv_records, "_RANGES_SENT", 0)
    got, want, _ = both(spark, write(tmp_path / "t.csv", rows))
    assert got == want and len(got) == 40


@pytest.mark.parametrize("line", ['a,"two\nlines"', 'a,"two\nlines",c,d', "a,b", 'a,"never closed,c', 'a,5" x,b\nc,7" x,d'])
def test_malformed_records_are_refused(spark, small_ranges, tmp_path, line):
    path = tmp_path / "t.csv"
    good = "\n".join(f'r{i},"two\nlines",c' for i in range(20))
    path.write_text(f"id,b,c\n{good}\n{line}\n{good}\n", newline="")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, str(path)).collect()


def test_other_quoting_stays_with_the_reader():
    assert csv_records.splittable(csv_options())
    for odd in ({"quote": "'"}, {"escape": "\\"}, {"multiLine": "false"}, {"encoding": "latin1"}):
        assert not csv_records.splittable({**csv_options(), **odd})


def test_only_a_header_or_nothing(spark, tmp_path):
    assert both(spark, write(tmp_path / "t.csv", []))[0] == []
    assert both(spark, write(tmp_path / "u.csv", [], header=("two\nlines", "b")))[0] == []
