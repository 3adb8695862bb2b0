"""Language identification by prediction by partial matching (PPM).

Per language a byte context tree of up to `order` bytes is counted on a bounded sample of labelled documents, and then frozen. A byte
costs -log2 of its probability in the longest context the language has seen, plus the escapes on the way there: with C bytes and D distinct
ones seen in a context, a byte seen c times has c / (C + D), escaping has D / (C + D), and below the empty context all bytes are
alike. The language with the shortest code for the whole text wins; the score is its share of 2^-length over all languages.

A text's code lengths under all languages are looked up together: every byte string of the longest context that any language has
seen has one row of finished costs, others fall back one byte at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import Chunk, chunks, lower
from tabwright.llm.documents import quoted

ORDER = 3
SAMPLE_BYTES = 2_000_000
LEAST_DOCUMENTS = 20
NONE = "und"
CLOSED = 1 << 32
_SLOTS = 21


def _grams(chunk: Chunk, order: int) -> np.ndarray:
    """Each byte with the `order` bytes before it in its document; a document begins after line ends."""
    buf = lower(chunk.buf).astype(np.uint32)
    grams = buf.copy()
    n = len(buf)
    for k in range(1, order + 1):
        grams[k:] |= buf[:n - k] << np.uint32(8 * k)
    for k in range(order):  # the first bytes of each document look back over its start
        at = chunk.offsets[:-1] + k
        at = at[at < chunk.offsets[1:]]
        mine = np.uint32((1 << 8 * (k + 1)) - 1)
        pad = sum(10 << 8 * j for j in range(k + 1, order + 1))
        grams[at] = grams[at] & mine | np.uint32(pad)
    return grams


class Trees:
    """Frozen costs in bits. By context length: seen strings and their cost per language; seen contexts and their escape cost."""

    def __init__(self, languages: list[str], order: int, grams: np.ndarray, language: np.ndarray, counts: np.ndarray):
        """grams, language, counts: how often a language has seen a byte after `order` bytes; CLOSED marks those counted for shorter contexts only."""
        self.languages, self.order = languages, order
        self.strings, self.costs, self.contexts, self.escapes = [], [], [], []
        width = len(languages)
        for k in range(order + 1):
            use = grams < CLOSED if k == order else np.ones(len(grams), bool)
            strings, at = np.unique((grams[use] & ((1 << 8 * (k + 1)) - 1)).astype(np.uint32), return_inverse=True)
            seen = np.zeros((len(strings), width))
            np.add.at(seen, (at, language[use]), counts[use])
            contexts, of = np.unique(strings >> np.uint32(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
            np.add.at(total, of, seen)
            np.add.at(distinct, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                own = -np.log2(seen / (total + distinct)[of])
            below = self._cost(strings & np.uint32((1 << 8 * k) - 1), k - 1) if k else np.full((len(strings), width), 8.0)
            self.strings.append(strings)
            self.contexts.append(contexts)
            self.escapes.append(escape.astype(np.float32))
            self.costs.append(np.where(seen > 0, own, escape[of] + below).astype(np.float32))
        self._slots = None

    def _cost(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Costs of bytes after k bytes, by language."""
        if k < 0:
            return np.full((len(keys), len(self.languages)), 8.0, np.float32)
        at = np.minimum(np.searchsorted(self.strings[k], keys), len(self.strings[k]) - 1)
        out = self.costs[k][at]
        miss = np.flatnonzero(self.strings[k][at] != keys)
        if len(miss):
            context = keys[miss] >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            escape = np.where((self.contexts[k][at] == context)[:, None], self.escapes[k][at], np.float32(0))
            out[miss] = escape + self._cost(keys[miss] & np.uint32((1 << 8 * k) - 1), k - 1)
        return out

    def cost(self, keys: np.ndarray) -> np.ndarray:
        """Costs of whole grams; the usual ones by one look into a table with a slot per hash."""
        strings = self.strings[self.order]
        if self._slots is None:
            self._slots = np.zeros(1 << _SLOTS, np.int32)
            self._slots[self._slot(strings)] = np.arange(len(strings))
        at = self._slots[self._slot(keys)]
        out = self.costs[self.order][at]
        miss = np.flatnonzero(strings[at] != keys)
        if len(miss):
            out[miss] = self._cost(keys[miss], self.order)
        return out

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)

    def lengths(self, chunk: Chunk) -> np.ndarray:
        """Code length of every document under every language."""
        out = np.zeros((len(chunk), len(self.languages)))
        some = np.flatnonzero(np.diff(chunk.offsets))
        if len(some) and self.languages:
            out[some] = np.add.reduceat(self.cost(_grams(chunk, self.order)), chunk.offsets[some], axis=0, dtype=np.float64)
        return out


def _count_batches(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for language in batch.column(1).unique():
                texts = batch.filter(pa.compute.equal(batch.column(1), language)).column(0)
                found = [np.unique(_grams(c, order), return_counts=True) for c in chunks(texts)]
                grams, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([f[1] for f in found]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([language.as_py()] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])
    return run


def _drawn(rows: DataFrame, sample_bytes: int, least: int) -> DataFrame:
    """Documents (text, lang) of every language, in the order of their draws: about `sample_bytes`, and at least `least` documents where there are that many."""
    rows = rows.where("octet_length(text) > 0").withColumn("draw", F.shiftrightunsigned("draw", 1))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))  # tasks pass on their own first rows only
    first = rows.select("lang", "draw").withColumn("place", place).where(f"place <= {least}").groupBy("lang").agg(F.max("draw").alias("nth"))
    share = F.least(F.lit(1.0), F.lit(float(sample_bytes)) / F.col("bytes")) * float(2 ** 63)
    upto = sizes.join(first, "lang").select(F.col("lang").alias("of"), F.greatest("nth", share.cast("long")).alias("upto"))
    return rows.join(F.broadcast(upto), F.col("of") == F.col("lang")).where("draw <= upto").select("text", "lang")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, sample_bytes: int = SAMPLE_BYTES, least_documents: int = LEAST_DOCUMENTS) -> Trees:
    """Count the trees on about `sample_bytes` of each language, and on at least `least_documents` documents of it (all, if it has fewer).

    A document is drawn by a hash of its whole row, so copies with other ids are drawn one by one, rows that repeat as a whole together. Rows without text or
    language teach nothing; every other language is learned. Contexts of three bytes are kept if they make up at least 1/65,536 of a language's sampled bytes
    (their counts always serve the shorter contexts), so that the model is bounded per language whatever the sample holds. It has a column of costs per
    language, so `lang` must name languages and not be free text. An empty table gives trees without a language.
    """
    if not 0 <= order <= 3:
        raise ValueError("order must be 0 to 3")
    rows = labelled.select(quoted(text).alias("text"), quoted(lang).alias("lang"), F.xxhash64(*map(quoted, labelled.columns)).alias("draw")).where("text is not null and lang is not null")
    chosen = _drawn(rows, sample_bytes, least_documents)
    counts = chosen.mapInArrow(_count_batches(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    if order > 2:
        context = F.shiftright("gram", 8)
        rare = counts.groupBy(F.col("lang").alias("of"), context.alias("of_context")).agg(F.sum("n").alias("in_context"))
        least = counts.groupBy(F.col("lang").alias("of2")).agg(F.expr("sum(n) / 65536").alias("least"))
        rare = rare.join(F.broadcast(least), F.col("of2") == F.col("of")).where("in_context < least").select("of", "of_context")
        counts = (counts.join(rare, (F.col("of") == F.col("lang")) & (F.col("of_context") == context), "left")
                  .withColumn("gram", F.expr(f"if(of is null, gram, (gram & 16777215L) + {CLOSED}L)")).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    table = counts.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    place = {x: i for i, x in enumerate(languages)}
    return Trees(languages, order, table["gram"].to_numpy(), np.array([place[x] for x in table["lang"].to_pylist()], np.int64), table["n"].to_numpy())


def _predict_batches(trees: Trees, fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            letters = batch.column(1).to_numpy(zero_copy_only=False)
            lang, score, rate = [], [], []
            for chunk in chunks(texts):
                bits = trees.lengths(chunk)
                n = np.maximum(np.diff(chunk.offsets), 1)
                ok = letters[chunk.first:chunk.last].astype(bool) & bool(trees.languages)
                if trees.languages:
                    best = bits.argmin(1)
                    least = bits[np.arange(len(bits)), best]
                    share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                else:
                    best, least, share = (np.zeros(len(bits), np.int64), np.zeros(len(bits)), np.zeros(len(bits)))
                lang += [trees.languages[b] if o else NONE for b, o in zip(best, ok, strict=True)]
                score.append(np.where(ok, share, 0.0))
                rate.append(np.where(ok, least / n, 0.0))
            join = lambda x: np.concatenate(x) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(lang, pa.string()), pa.array(join(score)), pa.array(join(rate))],
                                             names=[f"_{i}" for i in range(fields)] + ["lang_pred", "score", "bits_per_byte"])
    return run


def predict(docs: DataFrame, trees: Trees, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of every row, with lang_pred, score (0 to 1) and bits_per_byte of the winning language.

    A null text and a text without a letter are `und` with score 0, as is everything if no language was learned. Equal code lengths go to the
    language that sorts first. Rows that repeat are predicted each for itself, and alike. Only the text is looked at.
    """
    out = _predicted(docs, trees, keep, text)
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score", "bits_per_byte")


def recognised(docs: DataFrame, trees: Trees, least_score: float, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose language is predicted with a score of at least `least_score`; those that are `und` go."""
    out = _predicted(docs, trees, docs.columns, text).where(f"lang_pred <> '{NONE}' and score >= {least_score}")
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))


def _predicted(docs: DataFrame, trees: Trees, keep: list[str], text: str) -> DataFrame:
    """Kept columns by number, so that their names cannot clash, and the prediction."""
    rows = docs.select(quoted(text).alias("text"), F.coalesce(quoted(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(keep)))
    kinds = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return rows.mapInArrow(_predict_batches(trees, len(keep)), kinds + ", lang_pred string, score double, bits_per_byte double")
