from collections import Counter

import re

import numpy as np
import pyarrow as pa

from tabwright.llm import decontamination as D
from tests.llm.fixtures import awkward, frame, repeated, sample


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def brute(docs, items, percent=80):
    out = {}
    for doc, text, _ in docs:
        w = tokens(text)
        for item, t in items:
            v = tokens(t)
            k = min(5, len(v))
            if not v:
                continue
            want = Counter(tuple(v[i:i + k]) for i in range(len(v) - k + 1))
            for s in range(len(w) - len(v) + 1):
                x = w[s:s + len(v)]
                if not set(x) & set(v):
                    continue
                got = Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))
                low, high = sum((got & want).values()), sum((got | want).values())
                if 100 * low >= percent * high:
                    row = out.setdefault((doc, item), [0, s, -1.0])
                    row[0] += 1
                    if low / high > row[2]:
                        row[1:] = [s, low / high]
    return {k: tuple(v) for k, v in out.items()}


def near(text, at):
    w = text.split()
    w[at] = "changed"
    return " ".join(w)


def test_pairs_match_brute_force_and_clean_documents_stay(spark):
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items = [*bench[:15], (500, "Tiny item"), (501, None), (502, "..."), (503, bench[0][1])]
    text = max((t for _, t in items[:15]), key=len)
    planted = [(2000, "Before it. " + text + " And after.", "en"), (2001, "x y z " + near(text, 1), "en"), (2002, near(text, 12), "en"), (2003, (text + " ") * 3, "en"), (2004, "a TINY, item!", "en")]
    rows = [*sample(spark, 40), *[r for r in awkward() if r[0] != 1009], *planted]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.first_word, r.similarity) for r in D.contaminated(frame(spark, rows), benchmark).collect()}
    want = brute(rows, items)
    assert got == want and {2000, 2003, 2004} <= {d for d, _ in got}
    sliced = D.contaminated(frame(spark, rows), benchmark, limit=800)
    assert {(r.doc_id, r.item_id) for r in sliced.collect()} == set(want)
    clean = D.remove_contaminated(frame(spark, repeated(rows)), benchmark)
    assert clean.columns == frame(spark, rows).columns
    dirty = {d for d, _ in want}
    assert sorted((r.doc_id or -1) for r in clean.collect()) == sorted((d or -1) for d, _, _ in repeated(rows) if d not in dirty)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, sample(spark, 5))
    assert D.contaminated(docs, none).count() == 0 and D.remove_contaminated(docs, none).count() == docs.count()
    assert D.contaminated(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    shingles = [rng.integers(1, 1 << 63, 30, dtype=np.uint64) for _ in range(40)]
    group = D._OfSize(34, list(range(40)), shingles, 23)
    for _ in range(200):
        base = int(group.prints[rng.integers(40)])
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            base ^= 1 << int(bit)
        want = [i for i, p in enumerate(group.prints.tolist()) if bin(p ^ base).count("1") <= 23]
        assert group.within(base).tolist() == want
    assert len(pa.array([])) == 0
