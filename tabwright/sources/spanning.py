"""Records of CSV files whose quoted cells span lines, found by all tasks at once.

Whether a line begins a record depends on every quote before it. So each line is first reduced to what it does to a reader that comes to it
outside of quotes, and to one that comes inside. Each byte range of a file chains its lines under both assumptions; the chain of ranges,
one small row each, then settles which one holds. With that known, every range cuts its own lines into records. Only a record that
crosses a border is put together by a shuffle, from at most two pieces a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabwright.sources.shared import durable

ENCODINGS = {"UTF-8": None, "UTF8": None, "US-ASCII": "US-ASCII", "ISO-8859-1": "ISO-8859-1", "LATIN-1": "ISO-8859-1", "LATIN1": "ISO-8859-1"}
_SPLITS = "spark.sql.files.minPartitionNum"
STRETCH = 4_000_000  # bytes of lines that a task turns into records at a time
_OUT, _IN, _CLOSED, _LINE_START = 0, 1, 2, 3  # a reader: in plain text, inside quotes, just behind a quote that closed, at a line's start
_BLOCKS = "file string, start long, end0 boolean, begins0 boolean, end1 boolean, begins1 boolean"


def _ends_inside(line: Column, separator: str, state: int) -> Column:
    """Whether a reader who comes to a line in `state` leaves it inside quotes. A quote opens a cell only where a cell begins."""
    parts = F.split(line, '"', -1)

    def step(state: Column, text: Column) -> Column:
        opens = text.endswith(separator) | ((state == _CLOSED) & (text == "")) | ((state == _LINE_START) & text.isin("", "\ufeff"))
        return F.when(state == _IN, F.lit(_CLOSED)).when(opens, F.lit(_IN)).otherwise(F.lit(_OUT))

    folded = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), F.lit(state), step) == _IN
    return F.when(F.instr(line, '"') > 0, folded).otherwise(F.lit(state == _IN))


def _lines(spark: SparkSession, path: str, separator: str, encoding: str) -> DataFrame:
    """Lines with the byte range they begin in, in the order of the file within each range."""
    value, charset = F.col("value"), ENCODINGS[encoding.upper()]
    line = F.decode(value.cast("binary"), charset) if charset else value
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), line.alias("line"))
    return lines.select("file", "start", "line", _ends_inside(F.col("line"), separator, _LINE_START).alias("o"), _ends_inside(F.col("line"), separator, _IN).alias("i"))


def _before(o: np.ndarray, i: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside quotes, and whether the last one ends so."""
    out, at = np.empty(len(o), bool), 0
    for k in np.flatnonzero(o | ~i).tolist():  # all other lines leave the reader as they found it
        out[at:k + 1] = inside
        inside, at = bool(i[k] if inside else o[k]), k + 1
    out[at:] = inside
    return out, inside


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of a batch that lie in one byte range."""
    if not batch.num_rows:
        return
    file, start = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = file.indices.to_numpy()
    cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield (file.dictionary[int(code[a])].as_py(), int(start[a])), a, b


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range and assumption: how it ends, and whether a record begins in it."""
    blocks: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        o, i = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        for key, a, b in _runs(batch):
            found = blocks.setdefault(key, [False, False, True, False])
            for at in (0, 2):
                inside, found[at] = _before(o[a:b], i[a:b], found[at])
                found[at + 1] |= not inside.all()
    rows = [(*k, *v) for k, v in blocks.items()]
    kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in _BLOCKS.split(", ")])


def _follow(blocks: pd.DataFrame) -> pd.DataFrame:
    """Settle the ranges of one file: how each begins, and in which earlier one the record began that is open there."""
    blocks, inside, owner, out = blocks.sort_values("start"), False, -1, []
    for b in blocks.itertuples():
        out.append((b.file, b.start, inside, owner))
        begins, inside = (b.begins1, b.end1) if inside else (b.begins0, b.end0)
        owner = b.start if begins else owner
    return pd.DataFrame(out, columns=["file", "start", "inside", "owner"])


class _Cutter:
    """Cuts the lines of one byte range into records."""

    def __init__(self, key: tuple[str, int], inside: bool, owner: int):
        self.key, self.inside, self.owner = key, inside, owner
        self.open: list[str] | None = [] if inside else None  # lines of the record that is not complete yet
        self.foreign = inside                                  # it began in an earlier range
        self.header = key[1] == 0                              # the file's first record is still to come
        self.rows: list[tuple] = []                            # record, file, owner, start, whether it is a header

    def _done(self, ended: bool) -> None:
        if self.open is None:
            return
        text, file, start = "\n".join(self.open), *self.key
        if self.foreign:
            self.rows.append((text, file, self.owner, start, False))
        elif not ended:
            self.rows.append((text, file, start, start, self.header))
        elif text not in ("", "\r"):
            if not self.header:
                self.rows.append((text, None, None, None, False))
            self.header = False
        self.open, self.foreign = None, False

    def add(self, lines: pa.Array, o: np.ndarray, i: np.ndarray) -> pa.Array:
        """Take lines; records of one line are returned as they are, all others go to `rows`."""
        before, self.inside = _before(o, i, self.inside)
        starts = np.flatnonzero(~before)
        first = int(starts[0]) if len(starts) else len(lines)
        if self.open is not None:
            self.open += lines[:first].to_pylist()
        if not len(starts):
            return lines[:0]
        self._done(True)
        ends = np.append(starts[1:], len(lines))
        whole = ends - starts == 1
        whole[-1] = False  # it may go on in the next batch
        k = 0
        while self.header and k < len(starts) - 1:
            self.open, whole[k] = lines[int(starts[k]):int(ends[k])].to_pylist(), False
            self._done(True)
            k += 1
        for j in np.flatnonzero(~whole[k:-1]) + k:
            self.open = lines[int(starts[j]):int(ends[j])].to_pylist()
            self._done(True)
        self.open = lines[int(starts[-1]):].to_pylist()
        return lines.take(pa.array(starts[whole]))

    def finish(self) -> list[tuple]:
        self._done(not self.inside)
        return self.rows


_PIECES = "record string, file string, owner long, start long, header boolean"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in _PIECES.split(", ")])


def _stretches(line: pa.Array, a: int, b: int) -> list[tuple[int, int]]:
    """Lines a to b in stretches of about STRETCH bytes, so that records are put together from few lines at a time."""
    sizes = pc.fill_null(pc.binary_length(line[a:b]), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // STRETCH)) + 1 + a
    return list(zip([a, *cuts.tolist()], [*cuts.tolist(), b], strict=True))


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records with a null file, and pieces of records that cross a border with the range they began in."""
    cutter = None
    for batch in batches:
        line, inside, owner = batch.column(2), batch.column(5), batch.column(6)
        o, i = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
        for key, a, b in _runs(batch):
            if cutter is None or cutter.key != key:
                if not inside[a].is_valid:
                    raise RuntimeError(f"{key[0]} was split in another way than before; read it again")
                if cutter:
                    yield _piece_batch(cutter.finish())
                cutter = _Cutter(key, inside[a].as_py(), owner[a].as_py())
            for x, y in _stretches(line, a, b):
                whole = cutter.add(line[x:y], o[x:y], i[x:y])
                rows, cutter.rows = cutter.rows, []
                if rows:
                    yield _piece_batch(rows)
                if len(whole):
                    none = [pa.nulls(len(whole), t) for t in (pa.string(), pa.int64(), pa.int64())]
                    yield pa.RecordBatch.from_arrays([whole.cast(pa.string()), *none, pa.array(np.zeros(len(whole), bool))], names=[c.split()[0] for c in _PIECES.split(", ")])
    if cutter:
        yield _piece_batch(cutter.finish())


def records(spark: SparkSession, path: str, separator: str, encoding: str) -> DataFrame:
    """A row (record) per CSV record of a file or folder, in any order, header and empty ones left out.

    Lines end with a line feed, with or without a carriage return. The ranges of all passes must be the same, so the session's least number of file
    partitions, which otherwise follows the number of live cores, is fixed at its present value if it is unset; a range that differs
    all the same is an error, not a wrong row. The driver and the tasks hold one small row per range. A file whose last quote is
    never closed ends in one record, as it does for a reader that goes through it alone.
    """
    if spark.conf.get(_SPLITS, None) is None:
        spark.conf.set(_SPLITS, str(spark.sparkContext.defaultParallelism))
    lines = _lines(spark, path, separator, encoding)
    blocks = lines.select("file", "start", "o", "i").mapInArrow(_block_batches, _BLOCKS)
    blocks = durable(blocks.groupBy("file").applyInPandas(_follow, "file string, start long, inside boolean, owner long"), "ranges")
    pieces = lines.join(F.broadcast(blocks), ["file", "start"], "left").select("file", "start", "line", "o", "i", "inside", "owner").mapInArrow(_piece_batches, _PIECES)
    crossing = pieces.where("file is not null").groupBy("file", "owner").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda x: x["record"]), "\n").alias("record"), F.bool_or("header").alias("header"))
    crossing = durable(crossing.where("not header").select("record"), "crossing")
    whole = pieces.where("file is null").select("record").unionByName(crossing)
    record = F.col("record")
    return whole.select(F.when(record.endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(record).alias("record")).where("record <> ''")
