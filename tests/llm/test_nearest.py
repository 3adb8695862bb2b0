import math

import numpy as np
import pytest

from tabwright.llm import nearest as N


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, t int, g double, query string")


def usable(rows):
    """One vector per id, of the most common length, finite and not zero."""
    rows = [(i, v) for i, v in rows if i is not None and v is not None]
    lengths = [len(v) for _, v in rows]
    size = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if rows else 0
    out = {}
    for i, v in rows:
        if i not in out or v < out[i]:
            out[i] = v
    return {i: np.array(v, np.float64) for i, v in out.items() if len(v) == size and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)}


def brute(rows, every=20, most=20):
    good = usable(rows)
    out = {}
    for q in [i for i in good if i % every == 0]:
        near = sorted((-float((v * good[q]).sum()), i) for i, v in good.items() if i != q)[:most]
        out[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(near)]
    return out


def found(df, **how):
    out = {}
    for r in N.search(df, **how).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def recall(got, want):
    hits = sum(len({v for _, v, _ in got.get(q, [])} & {v for _, v, _ in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    want, got = brute(rows), found(df)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    vectors = usable(rows)
    for q, near in got.items():
        assert [k for k, _, _ in near] == list(range(1, 21)) and len({v for _, v, _ in near}) == 20
        assert [(-s, v) for _, v, s in near] == sorted((-s, v) for _, v, s in near)
        assert all(s == float((vectors[v] * vectors[q]).sum()) and v != q for _, v, s in near)


def test_unequal_lengths_need_the_largest_product(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=12) * rng.lognormal(0, 0.7)).tolist()) for i in range(3000)]
    want, got = brute(rows), found(frame(spark, rows, "double"))
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_groups_of_copies_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(6)
    same, other = rng.normal(size=8).tolist(), rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else other if i % 7 == 0 else rng.normal(size=8).tolist()) for i in range(1500)]
    want, got = brute(rows), found(frame(spark, rows, "double"), recall=0.99)
    assert recall(got, want) >= 0.9
    copies = [i for i, v in rows if v == same and i % 20 == 0]
    assert len(copies) == 25 and all(got[q] == want[q] for q in copies)  # a copy's nearest are the smallest ids among its copies


def test_awkward_rows(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (20, [1.0, 0.0, 0.0]), (1, [0.5, 0.5, 0.0]), (2, [0.0, 0.0, 0.0]), (3, [-0.0, 0.0, 0.0]), (4, None), (40, [math.nan, 1.0, 0.0]),
            (5, [math.inf, 0.0, 0.0]), (6, [None, 1.0, 0.0]), (7, [1.0, 2.0]), (8, []), (None, [1.0, 1.0, 1.0]), (60, [0.0, -1.0, 0.0]), (60, [0.0, -1.0, 0.0]), (61, [2.0, 2.0, 2.0]), (61, [-2.0, 2.0, 2.0])]
    want = brute(rows)
    assert found(frame(spark, rows)) == want and set(want) == {0, 20, 60}
    assert found(frame(spark, rows), most=2, every=10) == brute(rows, 10, 2)
    assert N.search(frame(spark, [])).count() == 0 and N.search(frame(spark, [(1, None), (20, [0.0])])).count() == 0
    assert N.search(frame(spark, [(0, [3.0])])).count() == 0  # nothing but itself
    with pytest.raises(ValueError):
        N.search(frame(spark, rows), most=0)


def test_probes_come_in_the_order_of_their_distance():
    sets = N.crossings(5, 243)
    assert len({s.tobytes() for s in sets}) == 243 and not sets[0].any()  # every neighbouring bucket once
    assert not (sets[:, :5] & sets[:, :4:-1]).any()
    rng = np.random.default_rng(1)
    inside = rng.random((7, 5))
    cells = np.zeros((7, 5), np.int64)
    for row, moves in zip(inside, N.probe_cells(cells, inside, sets, 243)):
        assert len({m.tobytes() for m in moves}) == 243 and set(np.unique(moves)) == {-1, 0, 1}
        cost = (np.where(moves < 0, row ** 2, 0) + np.where(moves > 0, (1 - row) ** 2, 0)).sum(1)
        assert (np.diff(cost) > -1e-12).all()
