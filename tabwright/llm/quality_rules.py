"""Quality rules as a short-circuit cascade.

Every document gets the base counts. Then each rule only sees the documents that all rules before it let through. Which order is cheapest
is estimated first: a sample of the documents is put through every rule by itself, and rules are ordered by the share they reject per
second they take. The order changes the work, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import Chunk, chunks, mix, prefix_hash, segment_hash, words
from tabwright.llm.documents import quoted

SAMPLE_ROWS = 2_000
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Texts:
    """A chunk with its words, lines and base counts; what rules look at beyond that is worked out for the documents they ask for."""

    def __init__(self, chunk: Chunk):
        self.chunk = chunk
        buf, offsets = chunk.buf, chunk.offsets
        self.starts, self.ends, self.first = words(chunk)
        self.n_words = np.diff(self.first)
        self.prefix = prefix_hash(buf)
        self.codes = segment_hash(self.prefix, self.starts, self.ends, buf)
        self.doc = np.repeat(np.arange(len(chunk)), self.n_words)
        points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        self.word_chars = np.bincount(self.doc, points[self.ends] - points[self.starts], len(chunk)).astype(np.int64)
        self.n_symbols = np.diff(np.concatenate([[0], np.cumsum(_SYMBOL[buf])])[offsets])
        self._lines()
        self.n_repeat_words = self._repeats()

    def _lines(self) -> None:
        """Lines with a word, and how many of them are equal to an earlier one."""
        buf, offsets = self.chunk.buf, self.chunk.offsets
        some = np.diff(offsets) > 0
        cuts = np.flatnonzero(buf == 10)
        starts, ends = np.sort(np.concatenate([offsets[:-1][some], cuts + 1])), np.sort(np.concatenate([cuts, offsets[1:][some]]))
        has = np.searchsorted(self.starts, starts) < np.searchsorted(self.starts, ends)
        starts, ends = starts[has], ends[has]
        doc = np.searchsorted(offsets, starts, "right") - 1
        self.n_lines = np.bincount(doc, minlength=len(self.chunk))
        distinct = np.unique(np.stack([doc.astype(np.uint64), segment_hash(self.prefix, starts, ends, buf)]), axis=1)[0] if len(doc) else doc
        self.n_dup_lines = self.n_lines - np.bincount(distinct.astype(np.int64), minlength=len(self.chunk))

    def _repeats(self) -> np.ndarray:
        """Words inside three-word windows that the document has twice or more."""
        c = self.codes
        if len(c) < 3:
            return np.zeros(len(self.chunk), np.int64)
        window = mix(c[:-2] + c[1:-1] * np.uint64(0xD6E8FEB86659FD93) + c[2:] * np.uint64(0xA0761D6478BD642F))
        at = np.flatnonzero(self.doc[:-2] == self.doc[2:])
        order = at[np.lexsort((window[at], self.doc[at]))]
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (window[order][1:] == window[order][:-1]) & (self.doc[order][1:] == self.doc[order][:-1])
        twice = order[same[1:] | same[:-1]]
        inside = np.zeros(len(c), bool)
        for k in range(3):
            inside[twice + k] = True
        return np.bincount(self.doc[inside], minlength=len(self.chunk))

    def base_failed(self) -> np.ndarray:
        return (self.n_words < 50) | (100 * self.n_repeat_words > 50 * self.n_words)

    def words_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of some documents, and of which of these documents each is."""
        n = self.n_words[docs]
        at = np.arange(n.sum()) + np.repeat(self.first[docs] - np.cumsum(n) + n, n)
        return at, np.repeat(np.arange(len(docs)), n)


# A rule takes the texts and the documents to judge, and says which it rejects.
Rule = Callable[[Texts, np.ndarray], np.ndarray]


def odd_word_length(t: Texts, docs: np.ndarray) -> np.ndarray:
    n, chars = t.n_words[docs], t.word_chars[docs]
    return (chars < 2 * n) | (chars > 15 * n)


def many_symbols(t: Texts, docs: np.ndarray) -> np.ndarray:
    return 10 * t.n_symbols[docs] > t.n_words[docs]


def repeated_lines(t: Texts, docs: np.ndarray) -> np.ndarray:
    return 2 * t.n_dup_lines[docs] > t.n_lines[docs]


def few_letters(t: Texts, docs: np.ndarray) -> np.ndarray:
    """Fewer than 80 % of the words have a letter (ASCII, or any character beyond)."""
    at, doc = t.words_of(docs)
    letters = np.concatenate([[0], np.cumsum(_LETTER[t.chunk.buf])])
    has = letters[t.ends[at]] > letters[t.starts[at]]
    return 10 * np.bincount(doc, has, len(docs)) < 8 * t.n_words[docs]


def _by_word(t: Texts, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and count of every distinct word."""
    at, doc = t.words_of(docs)
    code = t.codes[at]
    order = np.lexsort((code, doc))
    new = np.ones(len(order), bool)
    new[1:] = (code[order][1:] != code[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    place = np.flatnonzero(new)
    return doc[order][place], np.diff(np.append(place, len(order)))


def one_word_rules(t: Texts, docs: np.ndarray) -> np.ndarray:
    """The most frequent word makes up more than 30 % of all."""
    doc, n = _by_word(t, docs)
    most = np.zeros(len(docs), np.int64)
    np.maximum.at(most, doc, n)
    return 10 * most > 3 * t.n_words[docs]


def few_distinct_words(t: Texts, docs: np.ndarray) -> np.ndarray:
    """Fewer than 5 % of the words are distinct."""
    return 20 * np.bincount(_by_word(t, docs)[0], minlength=len(docs)) < t.n_words[docs]


RULES: dict[str, Rule] = {f.__name__: f for f in (odd_word_length, many_symbols, repeated_lines, few_letters, one_word_rules, few_distinct_words)}


def _measure_batches(rules: dict[str, Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                t = Texts(chunk)
                docs = np.flatnonzero(~t.base_failed())
                rows = []
                for name, rule in rules.items():
                    began = time.perf_counter()
                    rejected = int(rule(t, docs).sum()) if len(docs) else 0
                    rows.append((name, time.perf_counter() - began, rejected, len(docs)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["rule", "seconds", "rejected", "asked"])
    return run


def plan(docs: DataFrame, text: str = "text", rules: dict[str, Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds a document, share rejected) in the order of the cascade, from about `sample_rows` documents chosen by hash."""
    rules = RULES if rules is None else rules
    n = docs.count()
    rows = docs.select(quoted(text).alias("text")).where(f"pmod(xxhash64(text, 17), 1000000) < {1e6 * min(1.0, sample_rows / max(n, 1))}")
    table = rows.mapInArrow(_measure_batches(rules), "rule string, seconds double, rejected long, asked long").groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("asked").alias("asked")).collect()
    found = {r.rule: (r.seconds / max(r.asked, 1), r.rejected / max(r.asked, 1)) for r in table}
    costs = [(name, *found.get(name, (0.0, 0.0))) for name in rules]
    return sorted(costs, key=lambda x: (-x[2] / max(x[1], 1e-12), x[1], x[0]))


def _judge_batches(order: list[tuple[str, Rule]], fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                t = Texts(chunk)
                failed = t.base_failed()
                by = np.where(failed, "base", None)
                alive = np.flatnonzero(~failed)
                for name, rule in order:
                    if not len(alive):
                        break
                    out = rule(t, alive)
                    by[alive[out]] = name
                    alive = alive[~out]
                kept = np.zeros(len(chunk), bool)
                kept[alive] = True
                counts = [pa.array(np.asarray(getattr(t, c), np.int64)) for c in BASE]
                yield pa.RecordBatch.from_arrays([*(c.slice(chunk.first, len(chunk)) for c in batch.columns[1:]), *counts, pa.array(failed), pa.array(kept), pa.array(by, pa.string())],
                                                 names=[*(f"_{i}" for i in range(fields)), *BASE, "base_failed", "kept", "rejected_by"])
    return run


def judge(docs: DataFrame, keep: list[str], text: str = "text", rules: dict[str, Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The columns `keep` of every row with the base counts, base_failed, kept and rejected_by (the rule that came first in the cascade).

    A null or empty text has no words and fails. Rows are judged each for itself, so repeated rows get repeated verdicts; an empty table gives an empty result.
    Only rejected_by depends on the order of the rules.
    """
    rules = RULES if rules is None else rules
    order = [(name, rules[name]) for name, _, _ in plan(docs, text, rules, sample_rows)]
    rows = docs.select(quoted(text).alias("text"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(keep)))
    kinds = "".join(f"_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    added = [*BASE, "base_failed", "kept", "rejected_by"]
    out = rows.mapInArrow(_judge_batches(order, len(keep)), kinds + "".join(f"{c} long, " for c in BASE) + "base_failed boolean, kept boolean, rejected_by string")
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *added)
