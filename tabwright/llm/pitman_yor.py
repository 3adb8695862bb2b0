"""Language-model scores from a hierarchical Pitman-Yor process.

Tokens are words (A-Z in lower case) and one end per document. Every token is a customer of the restaurant of the word before it (the first one:
of the end). Each table there sends one customer to the restaurant of words, and each of its tables sends one
to the spelling restaurants: one per context of up to four bytes. Contexts that end in the same bytes share the restaurant of these bytes as
parent, down to the one without context above a uniform base. So an unseen word still has a probability from how it is spelled, and a word
never seen after another one from how often it opened tables elsewhere.

Seating is sampled by Gibbs sweeps. A sweep takes all customers of a dish out of a restaurant and seats them again, each opening a table with
its conditional probability given everything else; beyond forty customers those of the next five per cent are seated by one
draw. Draws depend on the dish and the sweep alone, so a lost task repeats the same seating. Predictive probabilities are averaged over the
sweeps after burn-in. Words, previous words and pairs of them cover all training documents, without a cut. Pairs are dealt to buckets by their rare word,
once to be counted and once more, with the places of their documents, to be scored beside the figures of the bucket's words; a task adds up what its buckets
have for a document. In between only pairs seen twice or more stay a table, since one seen once has one table in every sweep. The driver and
the tasks hold spelling cells, frequent words and frequent pairs, all bounded by shares: contexts of three and four bytes have a restaurant if they
make up 1/65,536 of all spelled bytes, of two bytes always, so there are 65,536 of each at most; words and pairs go to the tasks if
they make up 1/200,000 of all tokens. All rarer ones meet their figures in joins, so no key of a join is hot.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import chunks, cut, give_back, lower, mix, prefix_hash, segment_hash, words
from tabwright.llm.documents import HELD_OUT_HASH, one_row_per_id
from tabwright.sources.shared import durable, release, spent_shuffles

FREQUENT = 200_000
SWEEPS = 4
BURN_IN = 1
CONTEXTS = 65_536
SPELL_DISCOUNT = 0.5
STRENGTH = 1.0
_END = b"\n"
_FLUSH = 1_000_000
LARGE = 50_000           # words of a batch
BLOCK = 1_000_000        # tokens of a block of documents
BUCKET = 1_000_000       # tokens of a bucket, on average
TASK = 64_000_000        # tokens of a task that holds buckets, if there are more than for two tasks a core
HELD_DOCS = 8_000_000    # documents whose sums a task holds
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _uniform(seed: np.ndarray, step: int) -> np.ndarray:
    return (mix(seed + np.uint64(step * int(_GOLDEN) % (1 << 64))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _binomial(n: np.ndarray, p: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Binomial draws from uniform ones: by the distribution function, beyond a mean of twenty by the normal one."""
    mean = n * p
    out = np.zeros(len(n))
    some = np.flatnonzero(mean <= 20)
    k, chance = 0, np.exp(n[some] * np.log1p(-np.minimum(p[some], 1 - 1e-12)))
    below, ratio = chance.copy(), p[some] / np.maximum(1 - p[some], 1e-12)
    while len(go := np.flatnonzero((u[some] >= below) & (k < n[some]))):
        some, chance, below, ratio = some[go], chance[go], below[go], ratio[go]
        chance = chance * (n[some] - k) / (k + 1) * ratio
        below, k = below + chance, k + 1
        out[some] = k
        if k > 200:
            break
    many = np.flatnonzero(mean > 20)
    z = np.sqrt(-2 * np.log(np.maximum(u[many], 1e-300))) * np.cos(2 * np.pi * v[many])
    out[many] = np.clip(np.floor(mean[many] + np.sqrt(mean[many] * (1 - p[many])) * z + 0.5), 0, n[many])
    return out


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables of each dish after seating its customers one after the other; opening: weight of a new table."""
    tables = (customers > 0).astype(np.float64)
    at = np.flatnonzero(customers > 1)
    n, c, t, a, s = np.ones(len(at)), customers[at].astype(np.float64), tables[at], opening[at], seed[at]
    step = 0
    while len(at):
        size = np.minimum(np.maximum(1, np.floor(n * 0.05)), c - n)
        p = a / (a + n - discount * t)
        u = _uniform(s, 2 * step)
        new = (u < p).astype(np.float64)
        if (many := size > 1).any():
            new[many] = _binomial(size[many], p[many], u[many], _uniform(s[many], 2 * step + 1))
        t, n, step = t + new, n + size, step + 1
        if (done := n >= c).any():
            tables[at[done]] = t[done]
            at, n, c, t, a, s = (x[~done] for x in (at, n, c, t, a, s))
    return tables


class _Level:
    """The restaurants of one context length: a cell is context and byte, a sorted key."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray, parents: np.ndarray, opened: np.ndarray, sweep: int):
        d = SPELL_DISCOUNT
        self.keys, self.customers = keys, customers
        self.contexts, self.of = np.unique(keys >> 8, return_inverse=True)
        self.tables = seat(customers, (STRENGTH + d * opened[self.of] if len(opened) else np.full(len(keys), STRENGTH)) * parents, d, mix(keys.view(np.uint64) + np.uint64(sweep << 52)))
        self.total = np.bincount(self.of, customers, len(self.contexts))
        self.opened = np.bincount(self.of, self.tables, len(self.contexts))
        self.back = (STRENGTH + d * self.opened) / (STRENGTH + self.total)
        self.own = np.maximum(customers - d * self.tables, 0) / (STRENGTH + self.total[self.of])

    def __getstate__(self) -> dict:
        """What tasks need: a model is a file on every executor."""
        return {name: getattr(self, name) for name in ("keys", "contexts", "back", "own")}

    def probability(self, keys: np.ndarray, parents: np.ndarray) -> np.ndarray:
        at, has = _find(self.contexts, keys >> 8)
        p = parents * np.where(has, self.back[at], 1.0) if len(self.contexts) else parents
        at, has = _find(self.keys, keys)
        return p + np.where(has, self.own[at], 0.0) if len(self.keys) else p


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and which are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class _Hashes:
    """A sorted table of hashes. High bits, after those that all have in common, lead to the few places where a hash can be."""

    def __init__(self, table: np.ndarray, common: int = 0):
        self.table, self.common = table, np.uint64(common)
        bits = int(len(table)).bit_length() + 1
        self.drop = np.uint64(64 - bits)
        self.first = np.append(0, np.cumsum(np.bincount(self._slot(table), minlength=1 << bits))).astype(np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys << self.common) >> self.drop).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys, and which are there."""
        if not len(self.table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        slot = self._slot(keys)
        at = self.first[slot]
        beyond = self.first[slot + 1]
        at = np.minimum(at, np.int32(len(self.table) - 1))
        has = self.table[at] == keys
        left = np.flatnonzero(~has & (beyond - at > 1))
        while len(left):
            at[left] += 1
            has[left] = self.table[at[left]] == keys[left]
            left = left[~has[left] & (beyond[left] - at[left] > 1)]
        return at, has


def _mask(order: int) -> int:
    """Keeps the byte and the `order` bytes before it."""
    return (1 << 8 * (order + 1)) - 1


class Spelling:
    """Predictive probabilities of a byte after up to four bytes, from the customers of cells and one sweep of seating."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray, before: Spelling | None, sweep: int):
        """keys: the order in bits 48 and up, below it context and byte, at the longest open context."""
        order, cell = keys >> 48, keys & _mask(4)
        self.levels: dict[int, _Level] = {}
        sent_keys, sent = np.zeros(0, np.int64), np.zeros(0)
        for k in range(4, -1, -1):
            at = order == k
            got, back = np.unique(np.concatenate([cell[at], sent_keys & _mask(k)]), return_inverse=True)
            all_ = np.bincount(back, np.concatenate([customers[at], sent]), len(got))
            parents = before.probability(got & _mask(k - 1), k - 1) if before and k else np.full(len(got), 1 / 256)
            opened = np.zeros(0)
            if before:
                place, has = _find(before.levels[k].contexts, np.unique(got >> 8))
                opened = np.where(has, before.levels[k].opened[place], 0.0) if len(before.levels[k].contexts) else np.zeros(len(place))
            self.levels[k] = level = _Level(got, all_, parents, opened, sweep * 8 + k)
            sent_keys, sent = level.keys, level.tables

    def probability(self, keys: np.ndarray, order: int = 4) -> np.ndarray:
        p = np.full(len(keys), 1 / 256)
        for k in range(order + 1):
            p = self.levels[k].probability(keys & _mask(k), p)
        return p


def _spelled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells along every word with its closing blank, and where each word begins among them."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    word = np.repeat(np.arange(len(column)), np.diff(offsets))
    text = np.full(len(body) + 5 * len(column), 32, np.int64)
    text[np.arange(len(body)) + 5 * word + 4] = body
    keep = np.ones(len(text), bool)
    first = offsets[:-1] + 5 * np.arange(len(column))
    for i in range(4):
        keep[first + i] = False
    at = np.flatnonzero(keep)
    cells = text[at]
    for i in range(1, 5):
        cells |= text[at - i] << 8 * i
    return cells, offsets[:-1] + np.arange(len(column))


class Seating:
    """Everything a task needs: totals, discount, open contexts, and the spelling model and open tables of each sweep."""

    def __init__(self, tokens: int, types: int, discount: float, contexts: dict[int, np.ndarray]):
        self.tokens, self.types, self.discount, self.contexts = tokens, types, discount, contexts
        self.spelling: list[Spelling] = []
        self.tables: list[float] = []
        self.still = np.zeros(0, np.int64), np.zeros(0)

    def lean(self, *sweeps: int) -> Seating:
        """The model with the spelling of some sweeps only."""
        out = copy.copy(self)
        out.spelling, out.still = [x if i in sweeps else None for i, x in enumerate(self.spelling)], None
        return out

    def levelled(self, cells: np.ndarray) -> np.ndarray:
        """Cells at their longest open context, with its order in the high bits."""
        out = cells & _mask(2) | 2 << 48
        for k in (3, 4):
            open_ = _find(self.contexts[k], (cells & _mask(k)) >> 8)[1]
            out = np.where(open_, cells & _mask(k) | k << 48, out)
        return out

    def spelled(self, column: pa.Array, sweeps: range) -> dict[int, np.ndarray]:
        """log10 of each word's spelling, by sweep."""
        cells, first = _spelled(column)
        if not len(first):
            return {s: np.zeros(0) for s in sweeps}
        cells, back = np.unique(cells, return_inverse=True)
        return {s: np.add.reduceat(np.log10(self.spelling[s].probability(cells))[back], first) for s in sweeps}

    def tables_of(self, spelled: dict[int, np.ndarray], counts: np.ndarray, codes: np.ndarray, sweep: int) -> np.ndarray:
        if not sweep:
            return (counts > 0).astype(np.float64)
        opening = (STRENGTH + self.discount * self.tables[sweep - 1]) * 10 ** spelled[sweep - 1]
        return seat(counts, opening, self.discount, mix(codes + np.uint64(sweep << 50)))

    def probability(self, spelled: dict[int, np.ndarray], customers: np.ndarray, total: float, codes: np.ndarray, sweep: int) -> np.ndarray:
        """Predictive probability of words in one sweep."""
        own = customers - self.discount * self.tables_of(spelled, customers, codes, sweep)
        return (own + (STRENGTH + self.discount * self.tables[sweep]) * 10 ** spelled[sweep]) / (total + STRENGTH)

    def log10(self, spelled: dict[int, np.ndarray], counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Averaged predictive probability of words."""
        total = 0.0
        for s in range(BURN_IN, SWEEPS):
            total = total + self.probability(spelled, counts, self.tokens, codes, s)
        return np.log10(total / (SWEEPS - BURN_IN))


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of LARGE, since most cells of many words are the same."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        if (size := size + batch.num_rows) >= LARGE:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
            give_back()
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct key, and for every key which of these it is."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


def _codes(column: pa.Array) -> np.ndarray:
    """A hash per word, for its draws."""
    out = [segment_hash(prefix_hash(c.buf), c.offsets[:-1], c.offsets[1:], c.buf) for c in chunks(column)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _merged(found: list[tuple]) -> tuple[np.ndarray, pa.Array]:
    code, n, word = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), pa.concat_arrays([x[2] for x in found])
    at, back = _distinct(code)
    return np.bincount(back, n, len(at)).astype(np.int64), word.take(pa.array(at)), code[at]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, docs, ends_of_training = [], 0, 0, 0

    def out():
        n, word, _ = _merged(held)
        return pa.RecordBatch.from_arrays([word, pa.array(n)], names=["word", "n"])

    for batch in batches:
        docs += batch.num_rows
        learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        ends_of_training += int(learn.sum())
        for chunk in chunks(batch.column(0)):
            low = lower(chunk.buf)
            starts, ends, first = words(chunk)
            code = segment_hash(prefix_hash(low), starts, ends, low)
            order = np.argsort(code)
            code = code[order]
            new = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
            n = np.add.reduceat(np.repeat(learn[chunk.first:chunk.last], np.diff(first))[order], new) if len(new) else np.zeros(0, np.int64)
            code, at = code[new], order[new]
            held.append((code, n, cut(low, starts[at], ends[at])))
            size += len(code)
            if size > 4 * _FLUSH:
                n, word, code = _merged(held)
                held, size = [(code, n, word)], len(code)
                if size > _FLUSH:
                    yield out()
                    held, size = [], 0
    if held:
        yield out()
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array([_END], pa.binary()), pa.array([ends_of_training])], names=["word", "n"])


_CELLS = "cell long, n long, still long"


def _cell_batches(model: Seating, sweep: int):
    """Customers of every spelling cell after a sweep over the words (word, n, still[, spelled in the sweep before]), and those of them that still words send,
    which are the same after every sweep; under key -1 the number of tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [(np.zeros(0, np.int64), np.zeros((2, 0)))], 0

        def merged():
            keys, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return keys, np.stack([np.bincount(back, n, len(keys)) for n in np.concatenate([x[1] for x in held], axis=1)])

        for batch in _larger(batches):
            column, c, still = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            t = (c > 0).astype(np.float64)
            if sweep:
                some = np.flatnonzero(c > 1)
                part = column.take(pa.array(some))
                spelled = {sweep - 1: batch.column(3).to_numpy()[some]} if batch.num_columns > 3 else model.spelled(part, range(sweep - 1, sweep))
                t[some] = model.tables_of(spelled, c[some], _codes(part), sweep)
            cells, first = _spelled(column)
            lengths = np.diff(np.append(first, len(cells)))
            cells, back = np.unique(cells, return_inverse=True)
            sums = np.stack([np.bincount(back, np.repeat(x, lengths), len(cells)) for x in (t, t * still)])
            if model.contexts:
                cells = model.levelled(cells)
            held.append((np.append(cells, -1), np.append(sums, [[t.sum()], [(t * still).sum()]], axis=1)))
            if (size := size + len(cells)) > _FLUSH:
                held, size = [merged()], 0
        keys, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(n.astype(np.int64)) for n in counts)], names=["cell", "n", "still"])
    return run


def _levelled_batches(model: Seating):
    """Cells at their longest open context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.where(cells < 0, cells, model.levelled(cells))), *batch.columns[1:]], names=batch.schema.names)
    return run


def _probability_batches(model: Seating):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            column, c = batch.column(0), batch.column(1).to_numpy()
            logp = model.log10(model.spelled(column, range(SWEEPS)), c, _codes(column))
            yield pa.RecordBatch.from_arrays([column, batch.column(1), pa.array(logp)], names=["word", "n", "logp"])
    return run


def _ids(often: np.ndarray | _Hashes, codes: np.ndarray) -> np.ndarray:
    """A number per word: its place among the frequent ones, or a negative one from its hash."""
    at, hit = (often if isinstance(often, _Hashes) else _Hashes(often)).find(codes)
    return np.where(hit, at, (codes | np.uint64(1 << 63)).view(np.int64))


def _hashes(often: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The hash behind a word's number, so that draws do not depend on which words are frequent."""
    out = ids.view(np.uint64) | np.uint64(1 << 63)
    out[ids >= 0] = often[ids[ids >= 0]] | np.uint64(1 << 63)
    return out


def _pair_code(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(u.view(np.uint64) + _GOLDEN) + w.view(np.uint64))


def _tokens(chunk, often: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, previous word and word of every token, each document's end included."""
    low = lower(chunk.buf)
    starts, ends, first = words(chunk)
    code = segment_hash(prefix_hash(low), starts, ends, low)
    end = _ids(often, _codes(pa.array([_END], pa.binary())))[0]
    doc = np.repeat(np.arange(len(chunk)), np.diff(first) + 1)
    w = np.full(len(code) + len(chunk), end)
    w[np.arange(len(code)) + np.repeat(np.arange(len(chunk)), np.diff(first))] = _ids(often, code)
    u = np.empty_like(w)
    u[1:], u[:1] = w[:-1], end  # the token before a document is the end of the one before it
    return doc, u, w


def _id_batches(often: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_ids(often, _codes(batch.column(0)))), batch.column(0), batch.column(1)], names=["w", "word", "n"])
    return run


def _pair_order(u, w):
    """An order in which equal pairs are neighbours, and where a new one begins."""
    code = _pair_code(u, w)
    order = np.argsort(code)
    starts = lambda x, y: np.append(np.ones(min(len(x), 1), bool), (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    code, new = code[order], starts(u[order], w[order])
    if (new[1:] & (code[1:] == code[:-1])).any():  # two pairs of one code may lie in turns
        order = np.lexsort((w, u))
        new = starts(u[order], w[order])
    return order, new


def _pair_sums(u, w, n):
    order, new = _pair_order(u, w)
    at = np.flatnonzero(new)
    return u[order[at]], w[order[at]], np.add.reduceat(n[order], at) if len(at) else n


def _pair_batches(often: np.ndarray):
    """Every pair of neighbouring tokens with its count in training documents, summed up for some million tokens at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, hashes = [], 0, _Hashes(often)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _pair_sums(*map(np.concatenate, zip(*held)))], names=["u", "w", "n"])

        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for chunk in chunks(batch.column(0)):
                doc, u, w = _tokens(chunk, hashes)
                held.append(_pair_sums(u, w, learn[chunk.first:chunk.last][doc]))
                size += len(held[-1][0])
                if size > _FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
    return run


def _word_batches(model: Seating, sweep: int, total: float):
    """Words (w, word, n, spelled, ...) with their spelling in this sweep and, after all columns, their predictive probability from n customers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            column, c = batch.column(1), batch.column(2).to_numpy()
            spelled = model.spelled(column, range(sweep, sweep + 1)) | {sweep - 1: batch.column(3).to_numpy()}
            p = model.probability(spelled, c, total, _codes(column), sweep)
            kept = [pa.array(spelled[sweep]) if i == 3 else x for i, x in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*batch.schema.names, f"p{sweep}"])
    return run


def _still_batches(model: Seating, totals: list[float]):
    """Of still words (w, seen, word, n) the predictive probability in every sweep."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            column, c = batch.column(2), batch.column(3).to_numpy()
            spelled, codes = model.spelled(column, range(SWEEPS)), _codes(column)
            p = [pa.array(model.probability(spelled, c, totals[s], codes, s)) for s in range(SWEEPS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *p], names=["w", "seen", *(f"p{s}" for s in range(SWEEPS))])
    return run


def _pair_tables(code, n, opened, p, discount: float, sweep: int) -> np.ndarray:
    """Tables of every pair in its context's restaurant; opened and p are those of the sweep before."""
    if not sweep:
        return (n > 0).astype(np.float64)
    return seat(n, (STRENGTH + discount * opened) * p, discount, mix(code + np.uint64(sweep << 50)))


def _pair_scores(often: np.ndarray, discount: float, u: np.ndarray, w: np.ndarray, n: np.ndarray, contexts: np.ndarray, words_: np.ndarray) -> np.ndarray:
    """log10 of the averaged predictive probability of pairs, from figures (customers, tables by sweep) and (count, probability by sweep)."""
    several, sum_ = np.flatnonzero(n > 1), np.zeros(len(u))  # all others have one table or none
    code, t = _pair_code(_hashes(often, u[several]), _hashes(often, w[several])), (n > 0).astype(np.float64)
    for i in range(BURN_IN, SWEEPS):
        t[several] = _pair_tables(code, n[several], contexts[several, i], words_[several, i], discount, i)
        sum_ += (n - discount * t + (STRENGTH + discount * contexts[:, 1 + i]) * words_[:, 1 + i]) / (STRENGTH + contexts[:, 0])
    return np.log10(sum_ / (SWEEPS - BURN_IN))


def _pair_probability_batches(often: np.ndarray, discount: float):
    """Of (u, w, n, known, base, c, t0.., p0..) the averaged predictive probability."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, w, n = (batch.column(i).to_numpy() for i in range(3))
            contexts, words_ = (np.stack([batch.column(i).to_numpy().astype(np.float64) for i in at], axis=1)
                                for at in (range(5, 6 + SWEEPS), (2, *range(6 + SWEEPS, 6 + 2 * SWEEPS))))
            logp = _pair_scores(often, discount, u, w, n, contexts, words_)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(logp)], names=["u", "w", "n", "known", "base", "logp"])
    return run


def _own_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids.view(np.uint64) * _GOLDEN >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _bucket(u: np.ndarray, w: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a pair: that of its rare word, of the second one if both are, and by both words if none is."""
    return _own_bucket(np.where(w < 0, w, np.where(u < 0, u, (u + 1 << 32) + w)), buckets)


_PAIRS = (np.int64, np.uint32, np.int64, np.uint32)  # previous words, pairs of each, words, numbers of each pair
_COUNTED, _PLACED = (*_PAIRS, np.int64), (*_PAIRS, np.uint32)
_SEATED = (*_PAIRS[:3], np.int64)                      # and the count of each pair


def _pack(*columns: np.ndarray) -> bytes:
    """Columns in one compressed piece, byte by byte: the high bytes are mostly zero."""
    sizes = np.array([len(c) for c in columns], np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)
    return sizes + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def _unpack(piece: bytes, types: tuple) -> list[np.ndarray]:
    sizes = np.frombuffer(piece, np.int64, len(types)).tolist()
    total = sum(n * np.dtype(t).itemsize for n, t in zip(sizes, types))
    body = np.frombuffer(pa.decompress(piece[8 * len(types):], total, codec="zstd", asbytes=True) if total else b"", np.uint8)
    out, at = [], 0
    for n, t in zip(sizes, types):
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(body[at:at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


def _pieces(u: np.ndarray, w: np.ndarray, buckets: int, of_token: np.ndarray, counted: bool) -> Iterator[tuple[int, bytes]]:
    """Pairs of a block by bucket, previous words and pairs named once, with the numbers of their tokens or, `counted`, the sum of these."""
    k = _bucket(u, w, buckets)
    near = lambda x: x.view(np.uint64) * _GOLDEN >> np.uint64(40)
    order = np.argsort(k.astype(np.uint64) << np.uint64(48) | near(u) << np.uint64(24) | near(w))
    per_k = np.bincount(k)
    ends = np.cumsum(per_k)[per_k > 0]
    u, w, of_token = u[order], w[order], of_token[order]
    other_u, other = np.ones(len(u), bool), np.ones(len(u), bool)
    other_u[1:] = u[1:] != u[:-1]
    other_u[ends[:-1]] = True
    other[1:] = other_u[1:] | (w[1:] != w[:-1])
    pairs, runs = np.flatnonzero(other), np.flatnonzero(other_u)
    per_pair, per_u = np.diff(np.append(pairs, len(u))), np.diff(np.append(np.searchsorted(pairs, runs), len(pairs)))
    if counted:
        of_token = np.add.reduceat(of_token, pairs)
        per_pair = np.ones(len(pairs), np.int64)
    for bucket, a, b in zip(np.flatnonzero(per_k).tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist()):
        (i, j), (x, y) = (np.searchsorted(at, (a, b)) for at in (pairs, runs))
        tokens = slice(i, j) if counted else slice(a, b)
        yield bucket, _pack(u[runs[x:y]], per_u[x:y].astype(np.uint32), w[pairs[i:j]], per_pair[i:j].astype(np.uint32), of_token[tokens])


_BLOCK_ROWS = "k int, kind int, id long, n long, piece binary"
_WORD, _CONTEXT, _PIECE, _DOCS = range(4)  # kinds of rows in a bucket


def _block_rows(k, kind: int, id, n, pieces) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(np.full(len(k), kind, np.int32)), pa.array(id, pa.int64()), pa.array(n, pa.int64()),
                                       pa.array(pieces, pa.binary())], names=[c.split()[0] for c in _BLOCK_ROWS.split(", ")])


def _block_batches(often: np.ndarray, buckets: int, counted: bool):
    """Pairs of neighbouring tokens (text, learn[, doc_id]) in blocks of some million tokens: a row per block and bucket. `counted`: pairs with their
    count in training documents; else the place of each token's document in the block and whether it is learnt from, and a row with the block's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs, block, hashes = [], 0, 0, TaskContext.get().partitionId() << 32, _Hashes(often)

        def out():
            u, w, of_token = (np.concatenate([x[i] for x in held]) for i in range(3))
            k, pieces = zip(*_pieces(u, w, buckets, of_token, counted))
            yield _block_rows(k, _PIECE, np.full(len(k), block), np.full(len(k), docs), pieces)
            if not counted:
                ids, n_tokens = (np.concatenate([x[i] for x in held]) for i in (3, 4))
                yield _block_rows([block % buckets], _DOCS, [block], [docs], [np.concatenate([ids, n_tokens]).tobytes()])

        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for chunk in chunks(batch.column(0)):
                doc, u, w = _tokens(chunk, hashes)
                of_token = learn[chunk.first:chunk.last][doc]
                if counted:
                    held.append((u, w, of_token))
                else:
                    ids = batch.column(2).to_numpy()[chunk.first:chunk.last]
                    held.append((u, w, ((docs + doc) * 2 + of_token).astype(np.uint32), ids, np.bincount(doc, minlength=len(ids))))
                size, docs = size + len(u), docs + len(chunk)
                if size > BLOCK:
                    yield from out()
                    held, size, docs, block = [], 0, 0, block + 1
                    give_back()
        if held:
            yield from out()
            held = []
            give_back()
    return run


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows of a bucket one after the other in one of the tasks, figures first."""
    return rows.repartitionById(tasks, F.expr(f"k % {tasks}")).sortWithinPartitions("k", "kind")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    held, last = [], None
    for batch in batches:
        k = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(k)) + 1).tolist(), len(k)] if len(k) else []
        for a, b in zip(cuts, cuts[1:]):
            if held and k[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = int(k[a])
    if held:
        yield last, pa.Table.from_batches(held)


_COUNTS = "kind int, a long, b long, c long, d long, piece binary"
_SEVERAL, _OF_U, _OF_W, _ELSEWHERE = range(4)


def _bucket_counts(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
    """Of a bucket: pairs seen twice or more in one piece (bucket, those seen twice); previous words (u, n, pairs, pairs seen once); words (w, pairs, pairs seen once);
    and previous words whose figures are needed here although their own bucket is another one (bucket, u, whether for a pair seen twice or more)."""
    def rows(kind, *columns, piece=None):
        none = np.zeros(len(columns[0]), np.int64)
        columns = [pa.array(np.asarray(c).astype(np.int64)) for c in (*columns, none, none, none)[:4]]
        return pa.table([pa.array(np.full(len(none), kind, np.int32)), *columns, pa.array([piece] * len(none), pa.binary())], names=[c.split()[0] for c in _COUNTS.split(", ")])

    k = key[0].as_py()
    found = [_unpack(x, _COUNTED) for x in table["piece"].to_pylist()]
    u, w, n = _pair_sums(np.concatenate([np.repeat(x[0], x[1]) for x in found]), *(np.concatenate([x[i] for x in found]) for i in (2, 4)))
    rare = np.flatnonzero((u < 0) & (w < 0))
    far, back = np.unique(u[rare], return_inverse=True)
    again = np.bincount(back, n[rare] > 1, len(far)) > 0
    out = [rows(_ELSEWHERE, np.full(len(far), k), far, again)]
    u, w, n = (x[n > 0] for x in (u, w, n))
    if len(u):
        several = np.flatnonzero(n > 1)
        if len(several):
            several = several[np.argsort(u[several], kind="stable")]
            runs = np.flatnonzero(np.append(True, np.diff(u[several]) != 0))
            piece = _pack(u[several][runs], np.diff(np.append(runs, len(several))).astype(np.uint32), w[several], n[several])
            out.append(rows(_SEVERAL, [k], [np.count_nonzero(n == 2)], piece=piece))
        at, back = _distinct(u)
        out.append(rows(_OF_U, u[at], np.bincount(back, n), np.bincount(back), np.bincount(back, n == 1)))
        at, back = _distinct(w)
        out.append(rows(_OF_W, w[at], np.bincount(back), np.bincount(back, n == 1)))
    give_back()
    return pa.concat_tables(out)


_FIGURES = (np.int64, np.uint32, *[np.float64] * SWEEPS)  # word, count, a number by sweep
_FIGURE = (np.int64, np.float64)                          # word, the number of one sweep


def _figure_batches(buckets: int, kind: int, types: tuple = _FIGURES):
    """Figures of rare words (id, numbers) in a piece for their own bucket, or for the bucket in a last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            columns = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
            k = columns[len(types)] if len(columns) > len(types) else _own_bucket(columns[0], buckets)
            order = np.argsort(k)
            k, columns = k[order], [c[order].astype(t) for c, t in zip(columns, types)]
            ends = np.append(np.flatnonzero(np.diff(k)) + 1, len(k))
            spans = list(zip(np.append(0, ends[:-1]).tolist(), ends.tolist()))
            yield _block_rows([k[a] for a, _ in spans], kind, [0] * len(spans), [0] * len(spans), [_pack(*(c[a:b] for c in columns)) for a, b in spans])
    return run


def _figures(often: np.ndarray, frequent: pa.Table) -> np.ndarray:
    """Numbers of frequent words (id, numbers), a row for each; zeros for one that has none."""
    out = np.zeros((len(often), frequent.num_columns - 1))
    out[frequent.column(0).to_numpy()] = np.stack([x.to_numpy().astype(np.float64) for x in frequent.columns[1:]], axis=1)
    return out


def _looked_up(ids: np.ndarray, frequent: np.ndarray, pieces: list[bytes], types: tuple = _FIGURES) -> np.ndarray:
    """Rows of figures of words; zeros for those without any."""
    rare = np.flatnonzero(ids < 0)
    keys, *own = (np.concatenate(x) for x in zip(*(_unpack(x, types) for x in pieces))) if pieces else [np.zeros(0, t) for t in types]
    order = np.argsort(keys)
    at, has = _Hashes(keys[order].view(np.uint64), 1).find(ids[rare].view(np.uint64))
    table = np.zeros((len(frequent) + len(keys) + 1, len(types) - 1))
    table[:len(frequent)] = frequent
    for i, x in enumerate(own):
        table[len(frequent):-1, i] = x[order]
    place = ids.copy()
    place[rare] = np.where(has, len(frequent) + at, len(table) - 1)
    return table.take(place, axis=0)


def _draw_buckets(often: np.ndarray, contexts: np.ndarray, words_: np.ndarray, discount: float, sweep: int):
    """Seat the customers of a task's pairs again, from the tables of previous words and the probabilities of words in the sweep before; gives the tables
    that are opened, by previous word and by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, ids, t):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids), pa.array(t.astype(np.int64))], names=["kind", "of", "t"])

        sums = {kind: np.zeros(len(often)) for kind in (_OF_U, _OF_W)}
        for _, table in _by_bucket(batches):
            kinds = table["kind"].to_numpy()
            of = [table.take(pa.array(np.flatnonzero(kinds == i)))["piece"].to_pylist() for i in (_WORD, _CONTEXT, _PIECE)]
            for runs, per_u, w, n in (_unpack(x, _SEATED) for x in of[_PIECE]):
                u = np.repeat(runs, per_u)
                opened = np.repeat(_looked_up(runs, contexts, of[_CONTEXT], _FIGURE)[:, 0], per_u)
                p = _looked_up(w, words_, of[_WORD], _FIGURE)[:, 0]
                t = _pair_tables(_pair_code(_hashes(often, u), _hashes(often, w)), n, opened, p, discount, sweep)
                for kind, ids in ((_OF_U, u), (_OF_W, w)):
                    sums[kind] += np.bincount(ids[ids >= 0], t[ids >= 0], len(often))
                    rare, t_rare = ids[ids < 0], t[ids < 0]
                    at, back = _distinct(rare)
                    if len(at):
                        yield out(kind, rare[at], np.bincount(back, t_rare, len(at)))
            give_back()
        for kind, t in sums.items():
            yield out(kind, np.flatnonzero(t), t[t > 0])
    return run


def _score_buckets(often: np.ndarray, contexts: np.ndarray, words_: np.ndarray, discount: float, tokens: int, types: int):
    """Per block and task the sums over its documents' pairs of this task: known tokens, base and model. Rows of documents pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        out = lambda kind, ids, pieces: pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(np.full(len(ids), kind, np.int32)), pa.array(pieces, pa.binary())], names=["block", "kind", "piece"])
        for _, table in _by_bucket(batches):
            kinds = table["kind"].to_numpy()
            of = [table.take(pa.array(np.flatnonzero(kinds == i))) for i in range(4)]
            if len(of[_DOCS]):
                yield out(_DOCS, of[_DOCS]["id"].to_pylist(), of[_DOCS]["piece"].to_pylist())
            if not len(of[_PIECE]):
                continue
            found = [_unpack(x, _PLACED) for x in of[_PIECE]["piece"].to_pylist()]
            u, w = np.concatenate([np.repeat(x[0], x[1]) for x in found]), np.concatenate([x[2] for x in found])
            n = np.concatenate([np.add.reduceat((x[4] & 1).astype(np.int64), np.cumsum(x[3], dtype=np.int64) - x[3]) for x in found])
            order, new = _pair_order(u, w)
            at, pair = np.flatnonzero(new), np.empty(len(u), np.int64)
            pair[order] = np.cumsum(new) - 1
            u, w, n = u[order[at]], w[order[at]], np.add.reduceat(n[order], at)
            values = _pair_scores(often, discount, u, w, n, _looked_up(u, contexts, of[_CONTEXT]["piece"].to_pylist()),
                                  words := _looked_up(w, words_, of[_WORD]["piece"].to_pylist()))
            values = np.stack([words[:, 0] > 0, np.log10((words[:, 0] + 0.1) / (tokens + 0.1 * (types + 1))), values])
            first = 0
            for block, docs, x in zip(of[_PIECE]["id"].to_pylist(), of[_PIECE]["n"].to_pylist(), found):
                mine = values[:, np.repeat(pair[first:first + len(x[2])], x[3])]
                first += len(x[2])
                place = (x[4] >> 1).astype(np.int64)
                add = np.stack([np.bincount(place, v, docs) for v in mine])
                sums[block] = sums[block] + add if block in sums else add
            give_back()
            if sum(x.shape[1] for x in sums.values()) > HELD_DOCS:
                yield out(_PIECE, list(sums), [_pack(x[0].astype(np.uint32), x[1], x[2]) for x in sums.values()])
                sums = {}
        if sums:
            yield out(_PIECE, list(sums), [_pack(x[0].astype(np.uint32), x[1], x[2]) for x in sums.values()])
    return run


def _scored_block(table: pa.Table) -> pa.Table:
    """The documents of a block with the sums of all tasks."""
    docs, sums = (table.filter(pc.equal(table["kind"], i))["piece"].to_pylist() for i in (_DOCS, _PIECE))
    ids, n_tokens = np.frombuffer(docs[0], np.int64).reshape(2, -1)
    known, base, score = (sum(x) for x in zip(*(_unpack(x, (np.uint32, np.float64, np.float64)) for x in sums)))
    return pa.table({"doc_id": ids, "n_tokens": n_tokens, "n_known": known.astype(np.int64), "base": base, "score": score})


def _open_contexts(cells: DataFrame) -> dict[int, np.ndarray]:
    """Contexts of three and four bytes with a share of at least 1 / CONTEXTS of all spelled bytes: no more than CONTEXTS each."""
    cells = cells.where("cell >= 0")
    all_ = cells.agg(F.sum("n")).first()[0] or 0
    out = {}
    for k in (3, 4):
        of = F.expr(f"shiftright(cell & {_mask(k)}L, 8)").alias("context")
        got = cells.groupBy(of).agg(F.sum("n").alias("n")).where(f"n * {CONTEXTS} >= {all_}").select("context").toArrow()
        out[k] = np.sort(got["context"].to_numpy())
    return out


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _sweep(model: Seating, vocabulary: DataFrame, sweep: int) -> None:
    """Seat the customers of a table (word, n, still[, spelled in the sweep before]), and those that their tables send to the spelling restaurants.

    Still words, which have at most one customer in all sweeps and so the same tables, only count in the first one.
    """
    added = lambda cells: cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("still").alias("still"))
    lean = model.lean() if "spelled" in vocabulary.columns else model.lean(sweep - 1)
    cells = added((vocabulary.where("not still") if sweep else vocabulary).mapInArrow(_cell_batches(lean, sweep), _CELLS))
    if not sweep:
        cells = durable(cells, "cells")
        model.contexts = _open_contexts(cells)
        table = added(cells.mapInArrow(_levelled_batches(model.lean()), _CELLS)).toArrow()
        release(cells)
        model.still = table["cell"].to_numpy(), table["still"].to_numpy().astype(np.float64)
        keys, n = table["cell"].to_numpy(), table["n"].to_numpy().astype(np.float64)
    else:
        table = cells.toArrow()
        keys, n = (np.concatenate(x) for x in zip((table["cell"].to_numpy(), table["n"].to_numpy().astype(np.float64)), model.still))
    keys, back = np.unique(keys, return_inverse=True)
    n = np.bincount(back, n, len(keys))
    keys, n = keys[n > 0], n[n > 0]
    has = int(len(keys) > 0 and keys[0] == -1)
    model.tables.append(float(n[0]) if has else 0.0)
    model.spelling.append(Spelling(keys[has:], n[has:], model.spelling[-1] if sweep else None, sweep))


def _vocabulary(texts: DataFrame) -> DataFrame:
    return durable(texts.mapInArrow(_count_batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")


def _totals(table: DataFrame):
    """Sum of n, and how many n are above 0, 1 and 2."""
    all_, some, once, twice = table.agg(F.sum("n"), *(F.count_if(F.expr(x)) for x in ("n > 0", "n = 1", "n = 2"))).first()
    return all_ or 0, some, once, twice


def train(texts: DataFrame) -> tuple[Seating, DataFrame]:
    """Learn words without previous words from a table (text, learn). Returns the sampled model and the table (word, n, logp) of all words, n of those to learn from."""
    vocabulary = _vocabulary(texts)
    tokens, types, once, twice = _totals(vocabulary)
    model = Seating(tokens, types, _discount(once, twice), {})
    for sweep in range(SWEEPS):
        _sweep(model, vocabulary.select("word", "n", F.expr("n <= 1").alias("still")), sweep)
    return model, durable(vocabulary.mapInArrow(_probability_batches(model), "word binary, n long, logp double"), "probabilities")


def _joined(pairs: DataFrame, contexts: DataFrame, words_: DataFrame) -> DataFrame:
    """Pairs with the figures of the previous word and of the word. Frequent ones, which are few and hot, are broadcast."""
    out = None
    for u_often in (True, False):
        for w_often in (True, False):
            part = pairs.where(("u >= 0" if u_often else "u < 0") + (" and w >= 0" if w_often else " and w < 0"))
            of_u, of_w = contexts.where("u >= 0" if u_often else "u < 0"), words_.where("w >= 0" if w_often else "w < 0")
            part = part.join(F.broadcast(of_u) if u_often else of_u, "u", "left").join(F.broadcast(of_w) if w_often else of_w, "w")
            out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Restaurants:
    """A fitted model of pairs: `contexts` (u, c, t0..) has a previous word's customers and its tables by sweep, `words` (w, seen, p0..) a word's count
    and probability by sweep, `still` (w, seen, word, n) rare still words, whose probabilities follow from the `totals` of all sweeps. `elsewhere` (k, u) has buckets other than its own that need a
    previous word's figures. Nothing but `contexts` and `elsewhere` reads the tables `behind`."""

    seating: Seating
    often: np.ndarray
    discount: float
    buckets: int
    tasks: int
    contexts: DataFrame
    words: DataFrame
    still: DataFrame
    totals: list[float]
    elsewhere: DataFrame
    behind: list[DataFrame]


def _drawn(pairs: DataFrame, elsewhere: DataFrame, contexts: DataFrame, words_: DataFrame, often: np.ndarray, discount: float, buckets: int, tasks: int, sweep: int) -> DataFrame:
    """Tables (kind, of, t) that a sweep opens for pairs, added up in tasks; from (u, t) and (w, p) of the sweep before."""
    frequent = [_figures(often, x.toArrow()) for x in (contexts.where("u >= 0"), words_.where("w >= 0"))]
    rows = pairs.selectExpr("k", f"{_PIECE} as kind", "0L as id", "0L as n", "piece")
    far = elsewhere.where("again").join(contexts, "u").select(*contexts.columns, "k")
    for kind, figures in ((_WORD, words_.where("w < 0")), (_CONTEXT, contexts.where("u < 0")), (_CONTEXT, far)):
        rows = rows.unionAll(figures.mapInArrow(_figure_batches(buckets, kind, _FIGURE), _BLOCK_ROWS))
    return _dealt(rows, tasks).mapInArrow(_draw_buckets(often, *frequent, discount, sweep), "kind int, of long, t long")


def fit(texts: DataFrame) -> Restaurants:
    """Learn from a table (text, learn). Pairs are counted in buckets; only those seen twice or more are seated again in a sweep, the others have one table."""
    spark = texts.sparkSession
    vocabulary = _vocabulary(texts)
    tokens, types, _, _ = _totals(vocabulary)
    often = np.unique(_codes(vocabulary.where(f"n > 0 and n * {FREQUENT} >= {tokens}").select("word").toArrow().combine_chunks()["word"]))
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(tokens / TASK))
    buckets = tasks * max(1, math.ceil(tokens / BUCKET / tasks))
    blocks = texts.mapInArrow(_block_batches(often, buckets, True), _BLOCK_ROWS).select("k", "piece")
    counts = durable(blocks.groupBy("k").applyInArrow(_bucket_counts, _COUNTS), "counts", by=["kind"])
    of = lambda kind: counts.where(f"kind = {kind}")
    elsewhere = durable(of(_ELSEWHERE).selectExpr("cast(a as int) as k", "b as u", "c > 0 as again"), "elsewhere")
    pairs = durable(of(_SEVERAL).selectExpr("cast(a as int) as k", "b as twice", "piece"), "pairs")
    contexts = durable(of(_OF_U).groupBy(F.col("a").alias("u")).agg(F.sum("b").alias("c"), F.sum("c").alias("t0"), F.sum("d").alias("one")), "contexts")
    customers = of(_OF_W).groupBy(F.col("a").alias("of")).agg(F.sum("b").alias("t0"), F.sum("c").alias("one"))
    discount = _discount(contexts.agg(F.sum("one")).first()[0] or 0, pairs.agg(F.sum("twice")).first()[0] or 0)
    named = vocabulary.mapInArrow(_id_batches(often), "w long, word binary, n long").withColumnRenamed("n", "seen")
    all_words = durable(named.join(customers, F.col("of") == F.col("w"), "left").selectExpr(
        "w", "word", "coalesce(t0, 0L) as n", "0D as spelled", "seen", "coalesce(one, 0L) as one", "w < 0 and coalesce(t0 = one and t0 <= 1, true) as still"), "words")
    release(vocabulary, counts)
    total, _, once, twice = _totals(all_words)
    model, totals = Seating(tokens, types, _discount(once, twice), {}), []
    # what all sweeps leave as it is takes no part in them: previous words without a pair seen twice, and rare words after one word, once
    of_still = all_words.where("still").agg(F.sum("n")).first()[0] or 0
    words_, all_contexts, contexts = all_words, contexts, contexts.where("t0 > one")
    for sweep in range(SWEEPS):
        if sweep:
            drawn = durable(_drawn(pairs, elsewhere, contexts.select("u", F.col(f"t{sweep - 1}").cast("double").alias("t")), words_.select("w", f"p{sweep - 1}"),
                                   often, discount, buckets, tasks, sweep), "drawn")
            of_u, of_w = (drawn.where(f"kind = {kind}").groupBy("of").agg(F.sum("t").alias("t")) for kind in (_OF_U, _OF_W))
            before = [words_, drawn, *([contexts] if sweep > 1 else [])]
            contexts = durable(contexts.join(of_u, F.col("of") == F.col("u"), "left").select(*contexts.columns, F.expr(f"one + coalesce(t, 0L) as t{sweep}")), "contexts")
            words_ = durable(words_.join(of_w, F.col("of") == F.col("w"), "left").select(
                *[F.expr("one + coalesce(t, 0L) as n") if c == "n" else c for c in words_.columns]), "words")
            release(*before)
            total = of_still + (words_.agg(F.sum("n")).first()[0] or 0)
        totals.append(total)
        _sweep(model, words_.select("word", "n", "still", "spelled"), sweep)
        before = words_
        words_ = words_.where("not still")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words_.schema)
        words_ = words_.mapInArrow(_word_batches(model.lean(sweep), sweep, total), f"{schema}, p{sweep} double")
        if sweep == SWEEPS - 1:
            words_ = words_.select("w", "seen", *(f"p{i}" for i in range(SWEEPS)))
        words_ = durable(words_, "words")
        if sweep:
            release(before)
    release(pairs)
    behind = [all_contexts, contexts, elsewhere]
    contexts = contexts.unionAll(all_contexts.where("t0 = one").select("u", "c", "t0", "one", *(F.col("t0").alias(f"t{i}") for i in range(1, SWEEPS))))
    return Restaurants(model, often, discount, buckets, tasks, contexts, words_, all_words.where("still").select("w", "seen", "word", "n"), totals, elsewhere, behind)


def train_pairs(texts: DataFrame) -> tuple[Seating, np.ndarray, DataFrame]:
    """Learn from a table (text, learn). Returns the sampled model of words, the hashes of frequent words, and of all pairs of neighbouring tokens the table
    (u, w, n, known, base, logp): previous word, word, count in what is to learn, whether the word is in it, its add-0.1 unigram, and the model's probability."""
    model = fit(texts)
    pairs = durable(texts.mapInArrow(_pair_batches(model.often), "u long, w long, n long").groupBy("u", "w").agg(F.sum("n").alias("n")), "pairs")
    unigram = f"log10((seen + 0.1D) / ({model.seating.tokens} + 0.1D * ({model.seating.types} + 1))) as base"
    still = model.still.mapInArrow(_still_batches(model.seating, model.totals), "w long, seen long, " + ", ".join(f"p{i} double" for i in range(SWEEPS)))
    figures = model.words.unionAll(still).selectExpr("w", "cast(seen > 0 as long) as known", unigram, *(f"p{i}" for i in range(SWEEPS)))
    all_ = _joined(pairs, model.contexts.drop("one"), figures).selectExpr(
        "u", "w", "n", "known", "base", "coalesce(c, 0L) as c", *(f"coalesce(cast(t{i} as double), 0D) as t{i}" for i in range(SWEEPS)), *(f"p{i}" for i in range(SWEEPS)))
    schema = "u long, w long, n long, known long, base double, logp double"
    return model.seating, model.often, durable(all_.mapInArrow(_pair_probability_batches(model.often, model.discount), schema), "probabilities")


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """Score every document; learn from those whose crc32(id as text) mod `folds` is not 0.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-0.1 unigram) and score (log10 of the model's probability).
    A null or empty text is the end token alone. Without training documents the model is the uniform spelling. Rows without an id are left out; of rows that
    repeat an id the one with the smallest text counts. Other columns are ignored; an empty table gives an empty result. ids must be integers.
    """
    docs = one_row_per_id(docs, id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    held_out = F.expr(f"{HELD_OUT_HASH.format(id='doc_id')} % {folds} = 0")
    with spent_shuffles(docs.sparkSession):
        model = fit(docs.select("text", (~held_out).alias("learn")))
        contexts = model.contexts.selectExpr("u", "c", *(f"cast(t{i} as double) as t{i}" for i in range(SWEEPS)))
        frequent = [_figures(model.often, x.toArrow()) for x in (contexts.where("u >= 0"), model.words.where("w >= 0"))]
        # the join is done here, so that its shuffles are gone before the texts' pairs are dealt
        far = contexts.join(model.elsewhere.select("k", "u"), "u").select(*contexts.columns, "k")
        figures = durable(far.mapInArrow(_figure_batches(model.buckets, _CONTEXT), _BLOCK_ROWS).unionAll(
            contexts.where("u < 0").mapInArrow(_figure_batches(model.buckets, _CONTEXT), _BLOCK_ROWS)), "figures")
        release(*model.behind)
    rows = docs.select("text", (~held_out).alias("learn"), "doc_id").mapInArrow(_block_batches(model.often, model.buckets, False), _BLOCK_ROWS)
    of_words, of_still = _figure_batches(model.buckets, _WORD), _still_batches(model.seating.lean(*range(SWEEPS)), model.totals)
    rows = rows.unionAll(model.words.where("w < 0").mapInArrow(of_words, _BLOCK_ROWS))
    # both steps in one worker: a second one at a time would take as much memory again
    rows = rows.unionAll(model.still.mapInArrow(lambda batches: of_words(of_still(batches)), _BLOCK_ROWS)).unionAll(figures)
    run = _score_buckets(model.often, *frequent, model.discount, model.seating.tokens, model.seating.types)
    sums = _dealt(rows, model.tasks).mapInArrow(run, "block long, kind int, piece binary")
    scored = sums.groupBy("block").applyInArrow(_scored_block, "doc_id long, n_tokens long, n_known long, base double, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.seating.tokens).cast("long").alias("train_tokens"),
                         F.col("base").alias("base_score"), "score")
