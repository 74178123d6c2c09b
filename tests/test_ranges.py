"""Ranges of bytes against the csv module on whole files, cut at every byte."""

import csv
import io

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcel_jobs.operators.gates import GateClosed
from parcel_jobs.sources import feeds
from parcel_jobs.sources.ranges import Source, _effect, _records, _rows, read_ranges

HEADER = ["A", "B"]
#: Line breaks of all kinds in quotes, doubled quotes, plain quotes inside plain fields, empty fields, no last line's end.
TRICKY = 'A,B\n1,"x\ny"\n2,\n"a ""q"" b",é\r\n"""","\r\n,\n"\n3"4,5"\n"",""\n"x,","中\r"\r6,7\n,""""""\n8,"last\n"'


def whole(text, width=2):
    rows = list(csv.reader(io.StringIO(text, newline=""), strict=True))
    return [(*[*r, *[""] * width][:width], "width" if len(r) != width else "nul" if any("\0" in x for x in r) else None) for r in rows[1:]]


def by_ranges(path, cuts):
    """What the two passes give, without Spark."""
    n = path.stat().st_size
    bounds, state, rows = [0, *cuts, n], 0, []
    for start, stop in zip(bounds, bounds[1:], strict=False):
        source = Source(f"file:{path}", n)
        for data in _records(source, start, stop, state, 44, 1 << 20):
            rows += list(_rows(data, ","))
        settled, turns = _effect(source, start, stop, 44)
        state = (state + turns) % 2 if settled is None else settled
    return rows


@pytest.mark.parametrize("mark", ["", "﻿"])
def test_cut_at_every_byte(tmp_path, mark):
    path = tmp_path / "a.csv"
    path.write_bytes((mark + TRICKY).encode())
    want = list(csv.reader(io.StringIO(TRICKY, newline=""), strict=True))
    n = path.stat().st_size
    for cut in range(1, n):
        assert by_ranges(path, [cut]) == want, cut
    assert by_ranges(path, list(range(1, n))) == want
    for size in (2, 3, 5, 7, 11):
        assert by_ranges(path, list(range(size, n, size))) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=list('a",\n\ré "')), min_size=1, max_size=3), min_size=1, max_size=6), st.integers(1, 9), st.sampled_from(["\n", "\r\n", "\r"]))
def test_any_rows_come_back(tmp_path_factory, rows, size, end):
    path = tmp_path_factory.mktemp("any") / "a.csv"
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows([["A", "B"], *rows])
    path.write_bytes(out.getvalue().encode())
    assert by_ranges(path, list(range(size, path.stat().st_size, size))) == [["A", "B"], *rows]


def test_spark_reads_files_in_many_tasks(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.csv").write_text(TRICKY, newline="")
    (tmp_path / "d/b.csv").write_text("A,B\n" + "".join(f'{i},"{i}\n{"z" * (i % 90)}"\n' for i in range(300)) + "1\n1,2,3\n\nx,\0\n", newline="")
    want = whole(TRICKY) + whole((tmp_path / "d/b.csv").read_text())
    for size in (97, 1 << 20):
        df = feeds.read_strict_csv(spark, str(tmp_path / "d"), HEADER, range_bytes=size)
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    assert df.rdd.getNumPartitions() == 2 and read_ranges(spark, str(tmp_path / "d"), HEADER, range_bytes=100).rdd.getNumPartitions() > 50
    assert {"width", "nul", None} == {r[2] for r in want}


def test_quotes_that_break_the_rule_are_errors_of_their_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x"y\n2,ok\n"a" ,b\n3,"never closed\n4,5\n')
    for size in (4, 1 << 20):
        rows = feeds.read_strict_csv(spark, str(tmp_path / "a.csv"), HEADER, range_bytes=size).collect()
        assert sorted(map(tuple, rows), key=repr) == [("", "", "quote")] * 3 + [("2", "ok", None)]


def test_what_fails_the_job(spark, tmp_path):
    for name, data in {"drift": b"A,C\n1,2\n", "empty": b"", "latin": b"A,B\n\xe9,1\n", "blank": b"\nA,B\n"}.items():
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="drift|decode"):
            feeds.read_strict_csv(spark, str(tmp_path / name), HEADER).collect()
    (tmp_path / "long").write_text("A,B\n" + '"' + "x\n" * 400_000)
    with pytest.raises(Exception, match="a record of more than"):
        read_ranges(spark, str(tmp_path / "long"), HEADER, range_bytes=100, record_bytes=1000).collect()
    with pytest.raises(GateClosed):
        feeds.read_delimited_feed(spark, str(tmp_path / "drift"), HEADER)
    (tmp_path / "only").write_text("A,B\n")
    assert feeds.read_strict_csv(spark, str(tmp_path / "only"), HEADER).count() == 0


def test_a_range_without_quotes_changes_nothing(tmp_path):
    path = tmp_path / "a"
    path.write_bytes(b"abc\ndef\n" * 1000)
    assert _effect(Source(f"file:{path}", 8000), 10, 4000, 44) == (None, 0)
    assert np.array_equal(Source(f"file:{path}", 8000).read(0, 3), np.frombuffer(b"\nabc", np.uint8))
