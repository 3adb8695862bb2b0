"""Records that span lines, found in small byte ranges, against the library's reader that goes through a file alone."""

import random
from contextlib import contextmanager

import pytest

from tabwright.sources import csv, spanning


@contextmanager
def small_ranges(spark, size):
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def cell(draw):
    kind = draw.randrange(7)
    if kind == 0:
        return '"' + draw.choice(["", "a", ",", '""', "\n", "\r\n", "x\n\ny", '"",""', '""\n""']) * draw.randrange(1, 4) + '"'
    if kind == 1:
        return '"' + "long cell\nof many lines, with \"\"quotes\"\"\n" * draw.randrange(1, 12) + '"'
    if kind == 2:
        return draw.choice(['5" pipe', 'a"b', 'x""y', "", " ", "NA", "é"])
    return str(draw.randrange(1000))


def text(draw, rows, end):
    body = [",".join(cell(draw) for _ in range(draw.choice([1, 2, 3, 3, 3, 3, 4]))) for _ in range(rows)]
    return end.join(["id,note,more", *body]) + draw.choice(["", end])


def alone(spark, path, encoding="UTF-8"):
    options = csv._options(",", encoding, True)
    return spark.read.options(**options, header=True).schema("a string, b string, c string, d string").csv(path)



@pytest.mark.parametrize("size", [23, 300])
def test_records_equal_those_of_one_reader(spark, tmp_path, size):
    draw = random.Random(size)
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(text(draw, 20 if size < 100 else 60, "\n").encode())
    path = str(tmp_path)
    with small_ranges(spark, size):
        got = csv._raw(spark, path, ["a", "b", "c"], csv._options(",", "UTF-8", True)).collect()
    want = alone(spark, path).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_carriage_returns_latin_and_an_open_quote(spark, tmp_path):
    first = tmp_path / "latin"
    first.mkdir()
    body = 'id,note,more\r\n1,"\xe9\r\n\xfc",x\r\n\r\n2,plain,"y\nz"\r\n3,"never closed\nto the end, 4'
    (first / "a.csv").write_bytes(body.encode("latin-1"))
    with small_ranges(spark, 9):
        table = csv.read_csv(spark, str(first))
        rows = {r.id: (r.note, r.more) for r in table.rows.collect()}
    assert rows == {1: ("\xe9\r\n\xfc", "x"), 2: ("plain", "y\nz"), 3: ("never closed\nto the end, 4", None)}
    assert any("latin-1" in w for w in table.warnings)


def test_header_over_several_ranges_and_one_cell_over_all(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"a name\nof two lines",b\n1,"' + "line\n" * 40 + '"\n2,end\n')
    with small_ranges(spark, 19):
        got = spanning.records(spark, str(tmp_path), ",", "UTF-8").collect()
    assert sorted(r.record for r in got) == ['1,"' + "line\n" * 40 + '"', "2,end"]


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n" + '1,"two\nlines"\n' * 40_000)
    with small_ranges(spark, 50_000):
        records = spanning.records(spark, str(tmp_path), ",", "UTF-8")
        assert records.rdd.getNumPartitions() >= 8
        assert records.count() == 40_000 and records.distinct().count() == 1


def test_ranges_that_changed_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n" + '1,"two\nlines"\n' * 400)
    with small_ranges(spark, 500):
        records = spanning.records(spark, str(tmp_path), ",", "UTF-8")
    with small_ranges(spark, 333):
        with pytest.raises(Exception, match="split in another way"):
            records.select("record").where("record <> 'x'").collect()


def test_a_large_batch_is_cut_in_stretches():
    """What a task holds of records that span lines does not depend on the size of the batches it is given."""
    import numpy as np
    import pyarrow as pa

    n = 3_000
    lines = [x for k in range(n) for x in (f'{k},"' + "x" * 3_000, "y" * 3_000, 'z"')]
    o = np.array([True, False, False] * n)  # from outside: the first line of a record opens a cell
    i = np.array([False, True, False] * n)  # from inside: the last one closes it
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 3 * n), pa.array([7] * 3 * n), pa.array(lines), pa.array(o), pa.array(i),
                                        pa.array([False] * 3 * n), pa.array([-1] * 3 * n)], names=list("abcdefg"))
    out = list(spanning._piece_batches(iter([batch])))
    assert max(b.nbytes for b in out) < 2 * spanning.STRETCH
    assert [r for b in out for r in b.column(0).to_pylist()] == ["\n".join(lines[k:k + 3]) for k in range(0, 3 * n, 3)]


def test_records_are_cut_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n" + '1,"two\nlines"\n' * 400)
    rows = csv.read_csv(spark, str(tmp_path)).rows
    assert "MapInArrow" not in rows._jdf.queryExecution().toString() and rows.count() == 400
