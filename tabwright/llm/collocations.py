"""Phrase collocations by prefix-free parsing.

Every text is cut where two neighbouring words hash to a trigger. A chunk runs from its trigger through the window of the next one, so chunks
overlap by that window, and equal passages are cut into equal chunks wherever they stand. Distinct chunks with their frequencies, the
dictionary and the parse counts, are all that is counted from then on: a phrase belongs to the chunk in which it starts before the closing
window, which makes every occurrence count once, times the chunk's frequency.

Phrases are counted by length. A phrase of n words can only be frequent if its two parts of n - 1 words are, so only such phrases are
gathered; which parts are frequent travels as a bitmap of fixed size, whose false hits cost work but are counted like any other. Counts, cuts
and scores are joins over the frequent phrases, and each language's best come from a ranking in two steps, so that no language meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.bytesvec import Chunk, chunks, cut, lower, mix, prefix_hash, segment_hash, spans
from tabwright.llm.documents import quoted
from tabwright.operators.lookup import left_lookup
from tabwright.sources.shared import durable, temporary

PERIOD = 32  # words between two triggers, on average
FILTER_BITS = 26  # the bitmap of frequent parts has 2 to this power bits: 8 MB
FLUSH_ROWS = 500_000  # distinct phrases a task holds before it hands them on
SLICES = 256
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[10:14] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


def _parsed(column: pa.Array, window: int, period: int) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of texts: bytes, and for each parse chunk its document, start, end and number of words in its closing window."""
    for chunk in chunks(column):
        buf = lower(chunk.buf)
        starts, ends, first = spans(chunk, _GAP)
        if not len(starts):
            continue
        doc = np.repeat(np.arange(len(chunk)), np.diff(first))
        code = segment_hash(prefix_hash(buf), starts, ends, buf)
        opens = np.zeros(len(starts), bool)
        opens[first[:-1][np.diff(first) > 0]] = True
        if len(starts) >= window:
            seen = code[:len(code) - window + 1].copy()
            for j in range(1, window):
                seen = mix(seen) + code[j:len(code) - window + 1 + j]
            opens[:len(seen)] |= (mix(seen) % np.uint64(period) == 0) & (doc[:len(seen)] == doc[window - 1:])
        at = np.flatnonzero(opens)
        following = np.append(at[1:], len(starts))
        inside = following < first[doc[at] + 1]  # the next trigger is in the same text
        last = np.where(inside, following + window - 1, following - 1)
        yield chunk, buf, doc[at], starts[at], ends[np.minimum(last, len(ends) - 1)], np.where(inside, window, 0)


def _parse_batches(window: int, period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for chunk, buf, doc, starts, ends, tail in _parsed(batch.column(0), window, period):
                langs = batch.column(1).slice(chunk.first, len(chunk)).take(pa.array(doc))
                parts.append(pa.table({"lang": langs, "tail": tail.astype(np.int32), "chunk": cut(buf, starts, ends)}))
            if parts:
                table = pa.concat_tables(parts).group_by(["lang", "tail", "chunk"]).aggregate([([], "count_all")])
                yield from table.rename_columns(["lang", "tail", "chunk", "n"]).combine_chunks().to_batches()
    return run


def parse(docs: DataFrame, longest: int = 3, period: int = PERIOD, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: (lang, tail, chunk, n) with every distinct chunk, the words in its closing window and its frequency.

    A null language is `und`, a null text empty. The table is stored in the shared folder.
    """
    rows = docs.select(quoted(text).alias("text"), F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"))
    found = rows.mapInArrow(_parse_batches(max(longest - 1, 1), period), "lang string, tail int, chunk binary, n long")
    return durable(found.groupBy("lang", "tail", "chunk").agg(F.sum("n").alias("n")), "parse")


def _places(cells: np.ndarray) -> np.ndarray:
    return (cells >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _salted(code: np.ndarray, langs: pa.Array) -> np.ndarray:
    """Codes of phrases with their language mixed in."""
    names = langs.dictionary_encode()
    salt = np.array([sum((b + 1) * pow(1_000_003, i, 1 << 64) for i, b in enumerate(x.encode())) % (1 << 64) for x in names.dictionary.to_pylist()], np.uint64)
    return mix(code ^ salt[names.indices.to_numpy()]) if len(code) else code


def _filter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            code = segment_hash(prefix_hash(chunk.buf), chunk.offsets[:-1], chunk.offsets[1:], chunk.buf)
            at = np.unique(_places(_salted(code, batch.column(0).slice(chunk.first, len(chunk)))))
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """A flag per hash place that a frequent phrase has; its size does not depend on how many there are."""
    places = frequent.select("lang", "phrase").mapInArrow(_filter_batches, "at long")
    cells = places.groupBy(F.bitmap_bucket_number("at").alias("cell")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toArrow()
    flags = np.zeros(1 << FILTER_BITS, np.uint8)  # at most 2^26 / 32768 = 2048 rows of 4 KB
    per = 32_768
    for cell, bits in zip(cells["cell"].to_pylist(), cells["bits"].to_pylist()):
        # a bucket counts from 1, its first position is place 1
        block = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        first = 1 + (cell - 1) * per if cell > 0 else 0
        size = min(per, len(flags) - first)
        flags[first:first + size] |= block[:size]
    return np.packbits(flags)


def _merge(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
    return table.rename_columns(["lang", "phrase", "n"])


def _gram_batches(size: int, parts_seen):
    """Phrases of `size` words with their weight, for words of which both shorter parts are in the bitmap (none for single words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = None if parts_seen is None else parts_seen.value
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            langs, tails, weights = batch.column(0), batch.column(1).to_numpy(), batch.column(3).to_numpy()
            for chunk in chunks(batch.column(2)):
                starts, ends, first = spans(chunk, _GAP)
                if not len(starts):
                    continue
                doc = np.repeat(np.arange(chunk.first, chunk.last), np.diff(first))
                owned = first[1:][doc - chunk.first] - tails[doc]  # words from here on belong to the next chunk
                piece = np.concatenate([[0], np.cumsum(_BREAK[chunk.buf])])[starts]
                # the same words with one space after each, so that a phrase is one stretch of bytes
                length = ends - starts
                new_ends = np.cumsum(length + 1) - 1
                new_starts = new_ends - length
                line = np.full(int(new_ends[-1]) + 1, 32, np.uint8)
                line[np.arange(length.sum()) + np.repeat(np.arange(len(length)), length)] = chunk.buf[np.arange(length.sum()) + np.repeat(starts - (np.cumsum(length) - length), length)]
                n = len(starts) - size + 1
                if n <= 0:
                    continue
                at = np.arange(n)
                same = (doc[:n] == doc[size - 1:]) & (piece[:n] == piece[size - 1:])
                if flags is not None:
                    shorter = np.flatnonzero((doc[:n + 1] == doc[size - 2:]) & (piece[:n + 1] == piece[size - 2:]))
                    code = _salted(segment_hash(prefix_hash(line), new_starts[shorter], new_ends[shorter + size - 2], line), langs.take(pa.array(doc[shorter])))
                    where = _places(code)
                    some = np.zeros(n + 1, bool)
                    some[shorter] = flags[where >> 3] >> (7 - (where & 7)).astype(np.uint8) & 1
                    same &= some[:-1] & some[1:]
                at = at[same & (at < owned[:n])]
                if not len(at):
                    continue
                table = pa.table({"lang": langs.take(pa.array(doc[at])), "phrase": cut(line, new_starts[at], new_ends[at + size - 1]), "n": weights[doc[at]]})
                held.append(_merge([table]))
                rows += held[-1].num_rows
                if rows > FLUSH_ROWS:
                    held = [_merge(held)]
                    rows = held[0].num_rows
                    if 2 * rows > FLUSH_ROWS:
                        yield from held[0].combine_chunks().to_batches(max_chunksize=65_536)
                        held, rows = [], 0
        if held:
            yield from _merge(held).combine_chunks().to_batches(max_chunksize=65_536)
    return run


def count_phrases(dictionary: DataFrame, longest: int, least: int) -> tuple[list[DataFrame], DataFrame]:
    """Per length, (lang, phrase, f) of all phrases with f >= least, stored; and (lang, n), the words of each language."""
    spark = dictionary.sparkSession
    levels: list[DataFrame] = []
    totals = None
    for size in range(1, longest + 1):
        seen = spark.sparkContext.broadcast(_bitmap(levels[-1])) if size > 1 else None
        grams = dictionary.mapInArrow(_gram_batches(size, seen), "lang string, phrase binary, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        if size == 1:
            grams = durable(grams, "words")
            totals = grams.groupBy("lang").agg(F.sum("f").alias("n"))
        levels.append(durable(grams.where(F.col("f") >= least).select("lang", F.col("phrase").cast("string").alias("phrase"), "f"), f"grams{size}"))
    return levels, totals


def _key(phrase):
    """One column that names a phrase of a language; phrases hold no line break, so this is unambiguous."""
    return F.concat(F.col("lang"), F.lit("\n"), phrase)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2_000, period: int = PERIOD, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `longest` words of each language.

    A phrase with a >= `least` occurrences is a candidate. Of its cuts into two parts, with l and r occurrences, the one with the
    lowest floor(1000000 a a / (l r)) counts, the first among equals. Candidates inside a longer one that has at least `inside_percent` of
    their occurrences go. Best first: score, a, then the phrase in byte order. Words are split at blanks and tabs inside pieces, pieces
    at sentence marks and line breaks; A-Z are lower-cased.

    Null texts are empty and null languages `und`; repeated rows all count; an empty table gives an empty result. Other columns are not looked at.
    """
    with temporary(docs.sparkSession) as keep:
        dictionary = parse(docs, longest, period, text, lang)
        levels, totals = count_phrases(dictionary, longest, least)
        known = levels[0].withColumn("words", F.lit(1))
        for i, level in enumerate(levels[1:]):
            known = known.unionAll(level.withColumn("words", F.lit(i + 2)))
        known = durable(known.withColumn("key", _key(F.col("phrase"))), "known")
        sizes = known.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.when(F.col("words") == 1, F.col("f"))), F.lit(0)).alias("words")).first()
        candidates = known.where("words > 1")
        part = lambda first, last: F.array_join(F.slice(F.split("phrase", " "), first, last), " ")
        cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        cuts = cuts.select("lang", "phrase", "a", "k", _key(part(F.lit(1), F.col("k"))).alias("left"), _key(part(F.col("k") + 1, F.col("words") - F.col("k"))).alias("right"))
        for side, name in (("left", "l"), ("right", "r")):
            table = known.select(F.col("key").alias(side), F.col("f").alias(name), "f")
            cuts = left_lookup(cuts, table, side, name, "f", sizes["rows"], sizes["words"])
        # products of three counts below 10^15 fit 38 digits
        number = lambda c: F.col(c).cast("decimal(15,0)")
        cuts = cuts.withColumns({"_up": F.lit(1_000_000).cast("decimal(7,0)") * number("a") * number("a"), "_down": number("l") * number("r")})
        lowest = cuts.withColumn("score", F.expr("_up div _down")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
        inner = candidates.where("words > 2").select("lang", "f", "words", F.split("phrase", " ").alias("w"))
        inner = inner.select("lang", "f", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
        inner = inner.select("lang", "f", F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1), lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("phrase"))
        covered = inner.groupBy("lang", "phrase").agg(F.max("f").alias("covered"))
        good = lowest.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r").join(covered, ["lang", "phrase"], "left")
        good = good.where(F.col("covered").isNull() | (100 * F.col("covered") < inside_percent * F.col("a")))
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        sliced = good.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
        sliced = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
        best = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        best = best.join(totals, "lang")
        return keep(best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
