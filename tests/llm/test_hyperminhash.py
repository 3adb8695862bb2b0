import random

import numpy as np
import pytest

from tabwright.llm import components as C
from tabwright.llm import hyperminhash as H
from tests.llm.fixtures import awkward, frame, repeated, sample, words


def shingles(text, size):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size, percent=80):
    sets = {d: shingles(t, size) for d, t, _ in rows}
    best = {d: d for d in sets}

    def root(d):
        while best[d] != d:
            best[d] = best[best[d]]
            d = best[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if 10 * min(len(x), len(y)) < 7 * max(len(x), len(y)):
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                low, high = sorted((root(a), root(b)))
                best[high] = low
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def families():
    """Groups whose members are near the threshold: chains, stars, and a large group in which many pairs are not linked."""
    rng, rows = random.Random(11), []
    for f in range(12):
        n = [3, 5, 8, 12, 20, 40, 60, 90, 130, 200, 300, 500][f]
        base = [f"f{f}w{i}" for i in range(n)]
        for k in range(14):
            w = list(base)
            for _ in range(rng.randrange(1 + max(1, n // 9))):
                w[rng.randrange(n)] = f"new{rng.randrange(10 ** 6)}"
            rows.append((20_000 + 100 * f + k, " ".join(w), "en"))
            if f % 3 == 0:
                base = w
    base = [f"hub{i}" for i in range(60)]
    for k in range(150):
        w = list(base)
        for _ in range(3 + k % 3):
            w[rng.randrange(60)] = f"other{rng.randrange(10 ** 6)}"
        rows.append((30_000 + k, " ".join(w), "en"))
    return rows + [(40_000 + k, "the very same text as all of these", "en") for k in range(80)]


@pytest.mark.parametrize("size", [2, 5])
def test_groups_match_brute_force(spark, size):
    rows = sample(spark) + awkward() + families()
    got = {r.doc_id: tuple(r)[1:] for r in H.near_duplicates(frame(spark, rows), shingle=size).collect()}
    want = brute(rows, size)
    assert got == want and sum(not k for _, _, k in want.values()) > 100


def test_repeated_ids_and_empty_table(spark):
    rows = sample(spark, 10) + awkward()
    got = {r.doc_id: tuple(r)[1:] for r in H.near_duplicates(frame(spark, repeated(rows))).collect()}
    assert got == brute([(d, "" if t is None else t, g) for d, t, g in rows], 5)
    assert H.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(2)
    for n in (4, 20, 150, 1000, 20_000):
        for share in (0.5, 0.8, 0.95):
            got = []
            for _ in range(30 if n < 5000 else 8):
                x = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
                both = round(n * share)
                a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:both], x[n:2 * n - both]]))
                equal = (H._registers(a) == H._registers(b)).mean()
                got.append((equal - H.ACCIDENT) / (1 - H.ACCIDENT) - both / (2 * n - both))
            assert abs(np.mean(got)) < 0.03 and np.abs(got).max() < 0.16


def test_band_rows_bound_the_misses():
    r = H.band_rows(0.8)
    assert (1 - 0.8 ** r) ** (H.REGISTERS // r) <= 1e-5


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(5, 5), (None, 3)]
    best = {}
    for a, b in links:
        if a is not None and a != b:
            best.setdefault(a, a)
            best.setdefault(b, b)
    for _ in range(200):
        for a, b in links:
            if a in best and b in best and a != b:
                best[a] = best[b] = min(best[a], best[b])
    got = {r.node: r.component for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == best
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
