import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tabwright.llm import pitman_yor as P
from tabwright.sources import shared
from tests.llm.fixtures import awkward, frame, repeated, sample, words


def base(rows):
    tokens = {d: [*words(t), "\n"] for d, t, _ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    c = Counter(w for d, v in tokens.items() if not held[d] for w in v)
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for d, w in tokens.items()}


def test_base_matches_and_scores_are_probabilities(spark, monkeypatch):
    rows = sample(spark) + awkward()
    monkeypatch.setattr(P, "FREQUENT", 500)  # most words then take the join
    got = {r.doc_id: r for r in P.score(frame(spark, rows)).collect()}
    want = base(rows)
    assert got.keys() == want.keys()
    for d, w in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and math.isclose(r.base_score, w[4], rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    monkeypatch.setattr(P, "FREQUENT", 200_000)
    again = {r.doc_id: r for r in P.score(frame(spark, rows)).collect()}
    assert all(math.isclose(again[d].score, got[d].score, rel_tol=1e-9) and math.isclose(again[d].base_score, got[d].base_score, rel_tol=1e-9) for d in got)


def test_probabilities_of_all_words_sum_to_one(spark):
    texts = spark.createDataFrame([(t, True) for t in ["aa ab aa ba", "aa aa b b a ab", "b aa", None]], "text string, learn boolean")
    model, table = P.train(texts)
    rows = {bytes(r.word): (r.n, r.logp) for r in table.collect()}
    assert {k: n for k, (n, _) in rows.items()} == {b"aa": 5, b"ab": 2, b"ba": 1, b"b": 3, b"a": 1, b"\n": 4}
    seen = sum(10 ** p for _, p in rows.values())
    # what is left belongs to unseen words: the mass of new tables times the spelling of everything else
    rest = 0.0
    for s in range(P.BURN_IN, P.SWEEPS):
        spelled = model.spelled(pa.array(list(rows), pa.binary()), range(s, s + 1))[s]
        rest += (P.STRENGTH + model.discount * model.tables[s]) / (model.tokens + P.STRENGTH) * (1 - (10 ** spelled).sum())
    assert math.isclose(seen + rest / (P.SWEEPS - P.BURN_IN), 1, rel_tol=1e-9)


def test_spelling_is_a_distribution_under_every_context(spark):
    texts = spark.createDataFrame([(t, True) for _, t, _ in sample(spark, 30)], "text string, learn boolean")
    model, _ = P.train(texts)
    for context in (0x20202020, 0x20746865, 0x61626364, 0xC3A92074, 0):
        keys = np.int64(context) << 8 | np.arange(256)
        for m in model.spelling:
            assert math.isclose(m.probability(keys).sum(), 1, rel_tol=1e-9)


def test_seating_follows_the_restaurant_process():
    c, d, a = 400, 0.5, 3.0
    got = P.seat(np.full(4000, float(c)), np.full(4000, a), d, P.mix(np.arange(4000, dtype=np.uint64)))
    rng, want = np.random.default_rng(1), []
    for _ in range(1500):
        t = 1
        for n in range(1, c):
            t += rng.random() < a / (a + n - d * t)
        want.append(t)
    assert got.min() >= 1 and abs(got.mean() - np.mean(want)) < 0.35 and abs(got.std() - np.std(want)) < 0.35
    assert P.seat(np.array([0.0, 1.0]), np.array([1.0, 1.0]), d, np.zeros(2, np.uint64)).tolist() == [0, 1]


def test_held_out_texts_are_told_from_noise(spark):
    rows = [r for r in sample(spark, 200) if r[2] == "en" and len(r[1]) > 200]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 10 == 0]
    noise = [(10_000_000 + i, "".join(sorted(t)).replace(" ", "") or "x", "en") for i, (_, t, _) in enumerate(held)]
    noise = [(d + k, " ".join(t[j:j + 6] for j in range(0, len(t), 6)), g) for d, t, g in noise for k in range(40) if zlib.crc32(str(d + k).encode()) % 10 == 0][:len(held)]
    got = {r.doc_id: r.score / r.n_tokens for r in P.score(frame(spark, rows + noise)).collect()}
    assert held and max(got[d] for d, _, _ in noise) < min(got[d] for d, _, _ in held)


def test_repeated_ids_and_empty_tables(spark):
    rows = sample(spark, 10) + awkward()
    got = {r.doc_id: r.n_tokens for r in P.score(frame(spark, repeated(rows))).collect()}
    assert got == {d: len(words(t)) + 1 for d, t, _ in rows}
    assert P.score(frame(spark, rows).limit(0)).count() == 0
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = P.score(frame(spark, [(lone, "nothing to learn from", "en")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 5, 0, 0) and math.isclose(r.base_score, 0, abs_tol=1e-12) and math.isfinite(r.score)


def test_word_order_counts(spark):
    order = "the old man went down to the sea and looked at the boats for a long time".split()
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(i, " ".join(order), "en") for i in range(60) if i not in held] + [(held[0], " ".join(order), "en"), (held[1], " ".join(sorted(order)), "en")]
    got = {r.doc_id: r for r in P.score(frame(spark, rows)).collect()}
    fluent, scrambled = (got[d] for d in held)
    assert math.isclose(fluent.base_score, scrambled.base_score, rel_tol=1e-9) and fluent.score > scrambled.score + 5 and fluent.score > fluent.base_score


def test_words_after_every_word_sum_to_one(spark):
    texts = ["aa ab aa ba", "aa aa b b a ab", "b aa", None, "aa ab aa ab"]
    seen = ["aa", "ab", "ba", "b", "a", "zz", ""]
    everything = [f"{u} {w}" for u in seen for w in seen]
    model, often, table = P.train_pairs(spark.createDataFrame([(t, True) for t in texts] + [(t, False) for t in everything], "text string, learn boolean"))
    rows = table.collect()
    id_of = dict(zip(["\n", *seen[:-1]], P._ids(often, P._codes(pa.array([b"\n", *(x.encode() for x in seen[:-1])], pa.binary()))).tolist()))
    count = Counter((a, b) for t in texts for v in [["\n", *words(t), "\n"]] for a, b in zip(v, v[1:]))
    got = {(r.u, r.w): r for r in rows}
    assert len(got) == len(rows) and {k: got[id_of[k[0]], id_of[k[1]]].n for k in count} == dict(count)
    # the mass that is left for unseen words is the back-off weight of the context times what the words' restaurant leaves
    unseen = got[id_of["zz"], id_of["zz"]]
    assert unseen.n == 0 and unseen.known == 0
    # a context never seen gives the words' own probabilities, which any other context mixes with its own counts
    back = {w: 10 ** got[id_of["zz"], i].logp for w, i in id_of.items()}
    assert sum(back.values()) < 1
    for u in ("aa", "ab", "b", "\n"):
        total = sum(10 ** got[id_of[u], i].logp for i in id_of.values())
        assert sum(back.values()) < total < 1


def test_blocks_and_buckets_do_not_change_scores(spark, monkeypatch):
    df = frame(spark, sample(spark, 60) + awkward())
    monkeypatch.setattr(P, "FREQUENT", 500)
    whole = {r.doc_id: r for r in P.score(df).collect()}
    for name, size in (("BLOCK", 300), ("BUCKET", 200), ("TASK", 500), ("HELD_DOCS", 5)):
        monkeypatch.setattr(P, name, size)
    cut = {r.doc_id: r for r in P.score(df).collect()}
    assert cut.keys() == whole.keys()
    for d, r in whole.items():
        assert (cut[d].n_tokens, cut[d].n_known) == (r.n_tokens, r.n_known)
        assert math.isclose(cut[d].score, r.score, rel_tol=1e-9) and math.isclose(cut[d].base_score, r.base_score, rel_tol=1e-9)


def test_sums_of_pairs_hold_where_codes_collide(monkeypatch):
    monkeypatch.setattr(P, "_pair_code", lambda u, w: np.zeros(len(u), np.uint64))
    u, w, n = np.array([1, 2, 1, 2, 1]), np.array([5, 5, 5, 5, -6]), np.array([1, 1, 1, 0, 1])
    assert sorted(zip(*(x.tolist() for x in P._pair_sums(u, w, n)))) == [(1, -6, 1), (1, 5, 2), (2, 5, 1)]


def test_tables_of_finished_sweeps_and_their_shuffles_are_deleted(spark):
    before = set(shared._written)
    P.score(frame(spark, sample(spark, 20))).collect()
    assert len(set(shared._written) - before) <= 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_sweeps_leave_out_what_they_cannot_change(spark, monkeypatch):
    rows, seen = sample(spark, 60) + awkward(), []
    whole = {r.doc_id: r.score for r in P.score(frame(spark, rows)).collect()}
    sweep = P._sweep

    def counted(model, vocabulary, i):
        seen.append(vocabulary.count() if i else vocabulary.where("not still").count())
        sweep(model, vocabulary, i)

    monkeypatch.setattr(P, "_sweep", counted)
    monkeypatch.setattr(P, "FREQUENT", 500)
    got = {r.doc_id: r.score for r in P.score(frame(spark, rows)).collect()}
    all_words = Counter(w for d, t, _ in rows if zlib.crc32(str(d).encode()) % 10 for w in [*words(t), "\n"])
    assert len(set(seen)) == 1 and seen[0] <= sum(n > 1 for n in all_words.values()) < len(all_words)
    assert all(math.isclose(got[d], whole[d], rel_tol=1e-9) for d in whole)


def test_hashes_are_found_where_high_bits_are_equal():
    table = np.sort(np.concatenate([np.arange(40, dtype=np.uint64), P.mix(np.arange(500, dtype=np.uint64))]))
    table = np.unique(table)
    keys = np.concatenate([table, table + np.uint64(1), np.array([2 ** 64 - 1], np.uint64)])
    at, has = P._Hashes(table).find(keys)
    assert has.tolist() == np.isin(keys, table).tolist() and (table[at[has]] == keys[has]).all()
    assert not P._Hashes(table[:0]).find(keys)[1].any()


def test_tasks_get_only_the_sweeps_they_need():
    keys = np.unique(P._spelled(pa.array([f"word{i}".encode() for i in range(500)], pa.binary()))[0])
    model = P.Seating(500, 500, 0.5, {3: np.unique((keys & P._mask(3)) >> 8), 4: np.unique(keys >> 8)})
    for sweep in range(P.SWEEPS):
        model.tables.append(500.0)
        model.spelling.append(P.Spelling(np.unique(model.levelled(keys)), np.ones(len(keys)), model.spelling[-1] if sweep else None, sweep))
    sent = pickle.dumps(model.lean(2))
    assert len(sent) < len(pickle.dumps(model)) / 2
    words_ = pa.array([b"word7", b"other"], pa.binary())
    assert pickle.loads(sent).spelled(words_, range(2, 3))[2].tolist() == model.spelled(words_, range(2, 3))[2].tolist()
