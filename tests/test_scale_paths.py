"""The code paths meant for large tables, forced by small limits and compared with brute force."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabwright.operators import neighbors, ordered, prep, profile, split
from tabwright.operators.lookup import left_lookup


def skewed(spark, n=4000, seed=1):
    """A third of the rows hold one value."""
    rnd = random.Random(seed)
    rows = [(i, 5.0 if i % 3 == 0 else rnd.choice([rnd.random() * 100, float(rnd.randint(0, 9))]),
             None if i % 17 == 0 else rnd.gauss(0, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, a double, b double"), rows


PROBS = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


def test_quantiles_by_narrowing_equal_numpy(spark):
    df, rows = skewed(spark)
    got = ordered.exact_quantiles(df, {"a": PROBS, "b": PROBS}, bracket_rows=7)
    for j, c in ((1, "a"), (2, "b")):
        values = [r[j] for r in rows if r[j] is not None]
        assert got[c] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_quantiles_survive_a_poor_sketch(spark, monkeypatch):
    """With few cut points the guesses are wide or miss; the counts must notice."""
    monkeypatch.setattr(ordered, "CUTS", 3)
    df, data = skewed(spark, 900)
    got = ordered.exact_quantiles(df, {"a": [0.3, 0.77]}, bracket_rows=9)
    assert got["a"] == pytest.approx(list(np.quantile([r[1] for r in data], [0.3, 0.77])), rel=1e-12)


def test_quantiles_of_empty_and_constant_columns(spark):
    df = spark.range(100).select(F.lit(None).cast("double").alias("none"), F.lit(3.0).alias("same"))
    for direct in (0, 10**6):
        got = ordered.exact_quantiles(df, {"none": [0.5], "same": [0.1, 0.9]}, bracket_rows=direct + 1)
        assert got == {"none": [None], "same": [3.0, 3.0]}


def test_running_totals_over_partitions(spark):
    rnd = random.Random(2)
    rows = [(g, f"k{v:04d}", rnd.randint(1, 9)) for g in ("x", "y") for v in rnd.sample(range(9999), 500)]
    df = spark.createDataFrame(rows, "g string, v string, w bigint")
    got = {(r["g"], r["v"]): r["before"] for r in ordered.running_totals(df, "v", "w", ["g"]).collect()}
    down = {(r["g"], r["v"]): r["before"] for r in
            ordered.running_totals(df, "v", "w", ["g"], descending=True).collect()}
    for g in ("x", "y"):
        total = 0
        own = sorted((v, w) for h, v, w in rows if h == g)
        full = sum(w for _, w in own)
        for v, w in own:
            assert got[g, v] == total
            total += w
            assert down[g, v] == full - total


def test_running_totals_of_several_weights_in_small_batches(spark):
    rnd = random.Random(4)
    rows = [(g, h, v, rnd.randint(0, 9), rnd.random()) for g, h in ((1, "a"), (1, None), (2, None), (2, "b")) for v in rnd.sample(range(9999), 400)]
    rows += [(3 + i, "x", 1, 5, 0.5) for i in range(50)]  # groups of one row
    df = spark.createDataFrame(rows, "g int, h string, v bigint, n bigint, x double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r["g"], r["h"], r["v"]): r for r in ordered.running_totals(df, "v", {"n": "nb", "x": "xb"}, ["g", "h"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g, h in {(r[0], r[1]) for r in rows}:
        n, x = 0, 0.0
        for r in sorted(r for r in rows if r[:2] == (g, h)):
            assert got[r[:3]]["nb"] == n and abs(got[r[:3]]["xb"] - x) < 1e-9
            n, x = n + r[3], x + r[4]
    assert ordered.running_totals(df.limit(0), "v", "n", ["g"]).count() == 0


def test_numbered_rows(spark):
    rows = [(i, i * 7919 % 501, i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, v int, extra int").repartition(5)
    got = {r["id"]: r["place"] for r in ordered.numbered(df, [F.desc("v"), F.asc("id")], "place").collect()}
    assert got == {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert ordered.numbered(df.limit(0), [F.asc("id")], "place").count() == 0


@pytest.mark.parametrize("short", [500_000, 40, 0])
def test_spearman_of_long_and_short_columns(spark, monkeypatch, short):
    import numpy as np
    import pandas as pd

    monkeypatch.setattr("tabwright.operators.profile.SHORT_RANKS", short)
    monkeypatch.setattr("tabwright.operators.lookup.SMALL_TABLE_ROWS", 10)
    rng = np.random.default_rng(8)
    table = pd.DataFrame({"few": rng.integers(0, 5, 500), "hot": np.where(rng.random(500) < 0.5, 1.5, rng.normal(size=500)), "wide": rng.normal(size=500), "same": 3.0})
    table["near"] = table["wide"] * 2 + table["few"]
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.spearman(spark.createDataFrame(table)).collect()}
    want = table.corr(method="spearman")
    assert len(got) == 10
    for (a, b), c in got.items():
        assert (c is None) == ("same" in (a, b)) and (c is None or abs(c - want.loc[a, b]) < 1e-12)


def test_few_distinct_values_stop_at_the_limit(spark):
    from tabwright.operators import coltypes, counts

    rows = [(i, i % 3, f"t{i % 7}" if i % 5 else None, [0.0, -0.0, 1.5][i % 3], bool(i % 2), None) for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, few int, word string, x double, flag boolean, gone double").repartition(6)
    limits = {"id": 10, "few": 3, "word": 7, "x": 1, "flag": 5, "gone": 5}
    got = {r["column"]: r["n_unique"] for r in counts.few_distinct(df, limits).collect()}
    assert got == {"id": None, "few": 3, "word": 7, "x": None, "flag": 2, "gone": 0}
    # every task sees few values, all together have many
    own = spark.range(4000).repartitionByRange(8, "id").select((F.col("id") / 500).cast("int").alias("block"))
    assert counts.few_distinct(own, {"block": 7}).first()["n_unique"] is None
    assert counts.few_distinct(own, {"block": 8}).first()["n_unique"] == 8
    assert counts.few_distinct(df.limit(0), {"few": 2}).first()["n_unique"] == 0
    for counted, decided in ((coltypes.upload_types(df), coltypes.upload_types(df, counts=False)), (coltypes.profile_types(df), coltypes.profile_types(df, counts=False)),
                             (coltypes.target_candidates(df), coltypes.target_candidates(df, counts=False))):
        last = counted.columns[3] if "type" in counted.columns else "kind"
        want = {r["column"]: (r[last], r["n_unique"]) for r in counted.collect()}
        for r in decided.collect():
            kind, n = want.pop(r["column"])
            assert r[last] == kind and r["n_unique"] in (None, n)
        assert not want


def test_hash_cuts_by_radix_refinement(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("c"))
    ranks = {"hot": [0, 17, 999, 1999], "rare": [0, 500, 999]}
    near = ordered.hash_cuts(df, ["id"], ranks, "c", 42, 2000, bucket_rows=3)
    far = ordered.hash_cuts(df, ["id"], ranks, "c", 42, 2000)
    assert near == far and len(near) == 7


def test_split_sizes_and_folds(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b")
                                  .otherwise(F.when(F.col("id") > 20, "c")).alias("t"))
    train, test, dropped = split.train_test_split(df, ["id"], "t", 0.25)
    sizes = split.class_sizes(df, "t")
    quotas = split.test_quotas(sizes, 0.25)
    assert {r["t"]: r["count"] for r in test.groupBy("t").count().collect()} == quotas
    assert dropped == 2 and train.count() + test.count() == sum(sizes.values())
    assert train.join(test, "id").count() == 0
    folds = split.stratified_folds(df.where("t is not null"), ["id"], "t", 4)
    per = {(r["t"], r["fold"]): r["count"] for r in folds.groupBy("t", "fold").count().collect()}
    for c, n in sizes.items():
        own = [per.get((c, f), 0) for f in range(4)]
        assert sum(own) == n and max(own) - min(own) <= 1
    totals = [sum(per.get((c, f), 0) for c in sizes) for f in range(4)]
    assert max(totals) - min(totals) <= 1


def test_single_row_class_cannot_be_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id bigint, t string")
    with pytest.raises(ValueError):
        split.train_test_split(df, ["id"], "t")


def test_lookup_with_hot_keys_equals_plain_join(spark, monkeypatch):
    from tabwright.operators import lookup

    monkeypatch.setattr(lookup, "SMALL_TABLE_ROWS", 10)
    facts = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                     .otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("key"))
    table = facts.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).withColumn(
        "code", F.xxhash64("key")).where("key <> 'k1'")
    got = left_lookup(facts, table, "key", "code", "n", table.count(), 5000)
    want = facts.join(table.select("key", "code"), "key", "left")
    assert got.count() == 5000
    assert got.select("id", "key", "code").exceptAll(want.select("id", "key", "code")).count() == 0


def test_long_vocabulary_codes_are_sorted_ranks(spark, monkeypatch):
    rows = [(i, f"v{(i * 7919) % 500:03d}" if i % 3 else "v250", i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, word string, t int")
    config = prep.PrepConfig(target="t", encoder="label", scaler="none")
    plain = prep.Preparation.fit(df, config, [], ["word"]).to_columns(df, ["id"])
    monkeypatch.setattr(prep, "SMALL_TABLE_ROWS", 1)
    monkeypatch.setattr("tabwright.operators.lookup.SMALL_TABLE_ROWS", 1)
    wide = prep.Preparation.fit(df, config, [], ["word"]).to_columns(df, ["id"])
    order = {w: float(i) for i, w in enumerate(sorted({r[1] for r in rows}))}
    for out in (plain, wide):
        assert {r["id"]: r["word"] for r in out.collect()} == {i: order[w] for i, w, _ in rows}


def brute_neighbours(train, queries, k, p, group=False):
    out = {}
    for qk, qv, qg in queries:
        dist = []
        for tk, tv, tl, tg in train:
            if group and tg == qg:
                continue
            gap = np.abs(np.array(qv) - np.array(tv))
            d = gap.sum() if p == 1 else np.sqrt((gap * gap).sum())
            dist.append((round(float(d), 9), tk))
        out[qk] = [tk for _, tk in sorted(dist)[:k]]
    return out


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("group", [False, True])
def test_neighbours_in_blocks_equal_brute_force(spark, p, group):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 20, (6, 3))
    train = []
    for i in range(400):
        # a third of the rows are copies of one point, the rest lies in clumps
        v = [1.0, 2.0, 3.0] if i % 3 == 0 else (centres[i % 6] + rng.normal(0, 1, 3)).round(2).tolist()
        train.append((i, v, i % 4, i % 3 if group else 0))
    queries = [(1000 + i, ([1.0, 2.0, 3.0] if i % 5 == 0 else (centres[i % 6] + rng.normal(0, 2, 3)).tolist()),
                i % 3 if group else 0) for i in range(60)]
    t = spark.createDataFrame([(i, Vectors.dense(v), c, g) for i, v, c, g in train],
                              ["id", "features", "label", "fold"])
    q = spark.createDataFrame([(i, Vectors.dense(v), g) for i, v, g in queries], ["id", "features", "fold"])
    near = neighbors.neighbours(t, q, "id", 5, p, "fold" if group else None, block_rows=16)
    got = {}
    for r in near.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["neighbour"])
    assert got == brute_neighbours(train, queries, 5, p, group)


def test_rank_correlations_against_pairs(spark):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 6)), None if i % 9 == 0 else float(rnd.randint(0, 30)), rnd.random())
            for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.kendall(df).collect()}
    names = "abc"
    for i in range(3):
        for j in range(i + 1, 3):
            pts = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            s = tx = ty = 0
            for m in range(len(pts)):
                for n in range(m):
                    x, y = np.sign(pts[m][0] - pts[n][0]), np.sign(pts[m][1] - pts[n][1])
                    s, tx, ty = s + x * y, tx + x * x, ty + y * y
            assert got[names[i], names[j]] == pytest.approx(s / np.sqrt(tx * ty), abs=1e-12)


def test_constant_column_has_no_correlation(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.lit(0.1).alias("b"))
    for method in ("pearson", "spearman", "kendall"):
        assert profile.correlations(df, method).first()["corr"] is None


def test_pearson_equals_ml_stat(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_discount")
    vec = VectorAssembler(inputCols=df.columns, outputCol="v").transform(df)
    m = Correlation.corr(vec, "v").first()[0].toArray()
    for r in profile.pearson(df).collect():
        assert r["corr"] == pytest.approx(m[df.columns.index(r["col_a"]), df.columns.index(r["col_b"])], abs=1e-9)


def test_column_constant_in_the_rows_of_a_pair_has_no_correlation(spark):
    """The mean of the whole column, by which it is shifted, leaves dust in sums over the rows of the pair."""
    rows = spark.range(0, 900_000, 1, 7)
    df = rows.select(F.expr("case when id % 4 = 1 then id % 1009 end").alias("a"), F.expr("cast(id % 20 = 0 as double)").alias("b"),
                     F.expr("case when id % 4 = 1 then 0.1D + id * 0 end").alias("c"), F.lit(0.1).alias("d"))
    assert {r["corr"] for r in profile.pearson(df).collect()} == {None}


def test_rows_of_a_pair_far_from_the_mean_of_their_column(spark):
    df = spark.range(0, 9_000, 1, 4).selectExpr("case when id < 1000 then id % 7 end as a", "case when id < 1000 then id % 5 else 1e9 end as b")
    expected = df.where("a is not null").select(F.corr("a", F.col("b"))).first()[0]
    assert abs(profile.pearson(df).first()["corr"] - expected) < 1e-9


@pytest.mark.parametrize("p", [1, 2])
def test_a_block_search_holds_a_strip_of_distances(p):
    """Memory of a task does not grow with the square of its block, and rough distances lose no neighbour, far from zero or beside an outlier."""
    import tracemalloc

    rng = np.random.default_rng(8)
    t, q = rng.normal(size=(12_000, 8)) + 1e6, rng.normal(size=(600, 8)) + 1e6
    t[5], t[7], q[3] = 1e12, np.nan, t[9]
    keys, groups = rng.permutation(len(t)), (rng.integers(0, 3, len(t)), rng.integers(0, 3, len(q)))
    tracemalloc.start()
    found = list(neighbors.nearest_rows(keys, t, q, 5, p, *groups))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    i, j, dist = (np.concatenate(x) for x in zip(*found))
    assert peak < 60e6
    for n in range(0, len(q), 7):
        gap = np.abs(t - q[n])
        d = np.where(groups[0] == groups[1][n], np.nan, gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1)))
        want = np.lexsort((keys, np.round(d, neighbors.DIGITS)))[:5]
        assert j[i == n].tolist() == want.tolist() and np.allclose(dist[i == n], d[want], rtol=1e-12)


def block_of(rng, n, d, keys, far):
    v = rng.normal(size=(n, d)) + 1e3
    v[n // 2:n // 2 + 9] = v[0]
    return {"keys": keys, "v": v, "far": np.full(n, far), "may": rng.random(n) < 0.9, "g": rng.integers(0, 3, n).astype(float)}


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("d, far, outlier", [(7, np.inf, None), (16, 9.0, None), (16, 9.0, 1e9), (16, 30.0, 1e9), (300, 900.0, None)])
def test_a_distance_serves_both_rows_of_a_pair(monkeypatch, p, d, far, outlier):
    rng, far = np.random.default_rng(5), far / (4 if p == 2 else 1)
    keys = rng.permutation(2_700)
    a, b = block_of(rng, 300, d, keys[:300], far), block_of(rng, 2_400, d, keys[300:], far)
    b["v"][:40] = a["v"][:40]
    b["v"][50] = np.nan
    if outlier:
        a["v"][7, 2] = b["v"][9, 3] = outlier
    screens, cells = neighbors._mutual_screens, []

    def counted(*args):
        for number, screen in enumerate(screens(*args)):
            yield lambda i, j, x, y, number=number, screen=screen: (cells.append((number, len(x) * len(y))), screen(i, j, x, y))[1]

    monkeypatch.setattr(neighbors, "_mutual_screens", counted)
    sides = neighbors.mutual_rows(a, b, 4, p)
    if far in (9.0, 9.0 / 4) and not outlier:  # few pairs are near, so the first test is enough
        assert {n for n, _ in cells} == {0} and sum(c for _, c in cells) == 300 * 2_399
    for (i, j, dist), own, other in zip(sides, (a, b), (b, a)):
        for n in range(0, len(own["v"]), 11):
            gap = np.abs(other["v"] - own["v"][n])
            dists = gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
            dists = np.where(other["may"] & (other["g"] != own["g"][n]) & (dists <= far), dists, np.nan)
            want = np.lexsort((other["keys"], np.round(dists, neighbors.DIGITS)))[:min(4, np.isfinite(dists).sum())]
            assert j[i == n].tolist() == want.tolist() and np.array_equal(dist[i == n], dists[want])


@pytest.mark.parametrize("n, m, d", [(3, 8, 4), (5, 9, 7), (1, 1, 1), (130, 2048, 256)])
def test_sums_of_short_codes(n, m, d):
    rng = np.random.default_rng(2)
    a, b_t = rng.integers(0, 128, (n, d)).astype(np.uint8), rng.integers(0, 128, (d, m)).astype(np.uint8)
    a[0], b_t[:, 0] = 127, 0
    want = np.abs(a[:, :, None].astype(int) - b_t[None].astype(int)).sum(axis=1)
    assert np.array_equal(neighbors._rough_manhattan(a, b_t), want)


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("groups", [None, "few", "many"])
def test_a_table_searched_for_its_own_rows_equals_brute_force(spark, monkeypatch, p, groups):
    """Blocks of one group do not meet, others once; early meetings narrow the limits of the later ones; copies ask but do not answer."""
    for name, value in (("MUTUAL_CELLS", 12 * 25), ("MUTUAL_ROWS", 10), ("LIMIT_ROWS", 40), ("SEPARATE", 4)):
        monkeypatch.setattr(neighbors, name, value)
    rng = np.random.default_rng(9)
    train = []
    for i in range(320):
        v = [0.5] * 12 if i % 8 == 0 else rng.normal(0, 1, 12).round(3).tolist()
        train.append((i, v, i % 4, 0 if groups is None else i % 3 if groups == "few" else i % 7))
    df = spark.createDataFrame([(i, Vectors.dense(v), c, g) for i, v, c, g in train], ["id", "features", "label", "fold"])
    near = neighbors.neighbours(df, df, "id", 5, p, "fold" if groups else None)
    assert "CoGroupsInArrow" in near._jdf.queryExecution().toString()
    got = {}
    for r in near.orderBy("query", "rank").collect():
        assert r["label"] == r["neighbour"] % 4
        got.setdefault(r["query"], []).append(r["neighbour"])
    assert got == brute_neighbours(train, [(i, v, g) for i, v, _, g in train], 5, p, groups is not None)


def test_rows_of_repeated_keys_are_told_apart_once(spark):
    from tabwright.operators import split

    df = spark.range(900).selectExpr("id % 300 as key", "id as content", "id % 2 as t")
    train, test, _ = split.train_test_split(df, ["key"], "t", 0.25)
    assert "Window" not in train._jdf.queryExecution().toString() and train.columns == df.columns
    assert test.count() == 225 and train.unionAll(test).exceptAll(df).count() == 0 and train.count() == 675


def test_wide_vectors_equal_narrow_ones_and_name_no_slot(spark, monkeypatch):
    made = [(i, i % 3, float(i % 7) / 3 - 1, 0.0 if i % 2 else 1e-300 * i, f"name {i % 90}", f"kind {i % 70}") for i in range(400)]
    df = spark.createDataFrame(made, "id long, label int, x double, y double, name string, kind string")
    config = prep.PrepConfig(target="label", feature_columns=["x", "y", "name", "kind"], scaler="none")

    def vectors():
        p = prep.preprocess(df, config, ["id"])
        assert p.preparation.width() == 162
        unknown = df.withColumn("name", F.lit("never seen"))
        return p.train, [{r.id: r.features for r in t.collect()} for t in (p.train, p.test, p.preparation.transform(unknown, ["id"]))]

    _, narrow = vectors()
    monkeypatch.setattr(prep, "WIDE_COLUMNS", 100)
    rows, wide = vectors()
    assert wide == narrow and sum(map(len, wide)) == 800
    assert not rows.schema["features"].metadata
