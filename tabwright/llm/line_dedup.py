"""Line dedup by pairwise alignment.

Documents that overlap are found through shared runs of lines: from every line, and to every line, the shortest run that has the words of a block.
Every document is aligned with the first holder of each of its runs, so that the work is linear in the
lines and not in the pairs of holders; every block meets a document that has it whole. Lines without words do not count. A patience diff aligns the two: lines that occur once
in both, in the longest order that both follow, then the stretches between them again. What it leaves of the later document, lines that
repeat or stand in another order, is searched for all runs that the earlier one has. Blocks that are long enough
are deleted from the later document. The first holder of a run does not lose it for that run, so one copy of everything stays.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import chunks, prefix_hash, run_hash, segment_hash, signed, words
from tabwright.llm.documents import one_row_per_id
from tabwright.sources.shared import durable

LINE_WORDS = 4
BLOCK_WORDS = 8
_LINES = "doc_id long, lines array<long>, words array<int>"


def _lines(chunk):
    """Starts and ends of the lines of every document, and each document's first line."""
    buf, offsets = chunk.buf, chunk.offsets
    cuts = np.flatnonzero(buf == 10)
    some = np.diff(offsets) > 0
    starts = np.sort(np.concatenate([offsets[:-1][some], cuts + 1]))  # a line end that closes a document leaves an empty line in it
    ends = np.sort(np.concatenate([cuts, offsets[1:][some]]))
    first = np.concatenate([[0], np.cumsum(np.where(some, 1 + np.diff(np.searchsorted(cuts, offsets)), 0))])
    return starts, ends, first


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            starts, ends, first = _lines(chunk)
            at, to, _ = words(chunk)
            lo, hi = np.searchsorted(at, starts), np.searchsorted(at, ends)
            n = (hi - lo).astype(np.int32)
            has = n > 0
            # a line's key leaves out white space around it
            key = np.zeros(len(starts), np.uint64)
            key[has] = segment_hash(prefix_hash(chunk.buf), at[lo[has]], to[hi[has] - 1], chunk.buf)
            offsets = pa.array(first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, len(chunk)), pa.ListArray.from_arrays(offsets, pa.array(signed(key))), pa.ListArray.from_arrays(offsets, pa.array(n))],
                names=["doc_id", "lines", "words"])


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], ascending in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1 and in_a.get(x) == 1}
        piles, tops, back = [], [], {}
        for k in range(i, i_end):
            if (p := place.get(a[k])) is not None:
                pile = bisect_left(tops, p)
                back[k] = piles[pile - 1] if pile else None
                tops[pile:pile + 1], piles[pile:pile + 1] = [p], [k]
        k, chain = piles[-1] if piles else None, []
        while k is not None:
            chain.append((k, place[a[k]]))
            k = back[k]
        edge = (i, j)
        for k, p in reversed(chain):
            if k < edge[0]:
                continue
            out.append((k, p))
            todo.append((edge[0], k, edge[1], p))
            edge = (k + 1, p + 1)
        if chain:
            todo.append((edge[0], i_end, edge[1], j_end))
    return sorted(out)


def _minimal_runs(n_words: list[int], least: int) -> set[tuple[int, int]]:
    """From every line the shortest run of lines that has `least` words, and to every line; ends are exclusive."""
    runs, sums, start = set(), [0, *accumulate(n_words)], 0
    for end in range(1, len(sums)):
        while sums[end] - sums[start] >= least:
            runs.add((start, end))  # the first end that a start reaches
            start += 1
        if start and (before := bisect_right(sums, sums[end] - least) - 1) >= 0:
            runs.add((before, end))
    return runs


def _common_runs(a: list, b: list, n_words: list[int], least: int) -> set[int]:
    """The lines of b in any run of lines that a has too and that has `least` words, at any place and in any order; lines without words do not part a run.

    Every line of such a run is in a minimal run inside it, so the minimal runs are enough.
    """
    n = dict(zip(b, n_words, strict=True))
    places = [j for j, x in enumerate(b) if n[x]]
    a = [x for x in a if x]  # the key of a line without words is 0
    have = {tuple(a[i:k]) for i, k in _minimal_runs([n.get(x, least) for x in a], least)}  # a line that b does not have counts as a run of its own
    lines = [b[j] for j in places]
    out: set[int] = set()
    for i, k in _minimal_runs([n_words[j] for j in places], least):
        if tuple(lines[i:k]) in have:
            out.update(range(places[i], places[k - 1] + 1))
    return out


def common_blocks(a: list, b: list, n_words: list[int], least: int) -> list[int]:
    """The lines of b in blocks of at least `least` words that a has too: those of the alignment, then those that it leaves."""
    out, block, last = set(), [], None
    for i, j in [*patience(a, b), (-9, -9)]:
        if last != (i - 1, j - 1):
            if sum(n_words[x] for x in block) >= least:
                out.update(block)
            block = []
        block.append(j)
        last = (i, j)
    if any(n and j not in out for j, n in enumerate(n_words)):
        out |= _common_runs(a, b, n_words, least)
    return sorted(out)


def _align_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            earlier, later, n_words = (batch.column(i).to_pylist() for i in (1, 2, 3))
            gone = [common_blocks(*x, least) for x in zip(earlier, later, n_words, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "gone"])
    return run


def _run_batches(least: int):
    """The keys of every document's minimal runs: from each line with words, and to it, the shortest run that has `least` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, n_words = batch.column(1), batch.column(2)
            n = n_words.flatten().to_numpy()
            key = lines.flatten().to_numpy().view(np.uint64)[n > 0]
            doc = np.repeat(np.arange(batch.num_rows), lines.value_lengths().fill_null(0).to_numpy())[n > 0]
            sums = np.concatenate([[0], np.cumsum(n[n > 0], dtype=np.int64)])
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            ends = np.searchsorted(sums, sums[:-1] + least)
            starts = np.searchsorted(sums, sums[1:] - least, "right") - 1
            from_, to = np.flatnonzero(ends <= first[doc + 1]), np.flatnonzero(starts >= first[doc])
            start, end = np.concatenate([from_, starts[to]]), np.concatenate([ends[from_], to + 1])
            code = signed(run_hash(key, start, end))
            order = np.lexsort((code, doc[start]))
            code, of = code[order], doc[start][order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[new])), pa.array(code[new])], names=["doc_id", "key"])
    return run


def repeated_lines(docs: DataFrame, line_words: int = LINE_WORDS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Of a table (doc_id, text) with unique ids: the lines of every document, and (doc_id, gone), the places of the lines to delete.

    line_words has no effect any more: what is looked up are runs of lines of block_words words, whatever the words of each line.
    """
    table = durable(docs.mapInArrow(_line_batches, _LINES), "lines")
    keys = table.mapInArrow(_run_batches(block_words), "doc_id long, key long")
    owners = keys.groupBy(F.col("key").alias("of")).agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last").drop("last")
    pairs = keys.join(owners, F.col("of") == F.col("key")).where("owner < doc_id").select("owner", "doc_id").distinct()
    later = table.select(F.col("doc_id").alias("b"), F.col("lines").alias("later"), "words")
    earlier = table.select(F.col("doc_id").alias("a"), F.col("lines").alias("earlier"))
    both = pairs.join(later, F.col("b") == F.col("doc_id")).join(earlier, F.col("a") == F.col("owner")).select("doc_id", "earlier", "later", "words")
    gone = both.mapInArrow(_align_batches(block_words), "doc_id long, gone array<int>").where("size(gone) > 0")
    return table, gone.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", line_words: int = LINE_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text (without the deleted lines), n_lines, n_removed and removed (line numbers from 0), one row per document.

    Lines are parted by line ends; white space around a line does not count. A null text stays null and has no lines. Documents are ordered by id: of two
    that share a block the one with the larger id loses it. Rows without an id are left out; of rows that repeat an id the one with the smallest text
    counts. Other columns are ignored; an empty table gives an empty result. ids must be integers.
    """
    docs = one_row_per_id(docs, id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    _, gone = repeated_lines(docs, line_words, block_words)
    kept = "array_join(transform(array_except(sequence(0, size(parts) - 1), removed), i -> parts[i]), '\\n')"
    return (docs.join(gone.withColumnRenamed("doc_id", "of"), F.col("of") == F.col("doc_id"), "left")
            .select("doc_id", "text", F.expr("coalesce(gone, cast(array() as array<int>)) as removed"), F.split("text", "\n", -1).alias("parts"))
            .select("doc_id", F.expr(f"case when size(removed) = 0 then text when size(removed) >= size(parts) then '' else {kept} end as text"),
                    F.expr("case when text is null or text = '' then 0L else cast(size(parts) as bigint) end as n_lines"),
                    F.expr("cast(size(removed) as bigint) as n_removed"), "removed"))
