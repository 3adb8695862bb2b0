import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tabwright.llm import langid
from tabwright.llm.bytesvec import chunks
from tabwright.llm.documents import HELD_OUT_HASH
from tests.llm.fixtures import LOWER, awkward, frame, repeated, sample


def ppm(training, order, deep):
    """Code lengths by dictionaries; deep: contexts of full length that are kept."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for text in training:
        body = b"\n" * order + text.translate(LOWER).encode()
        for i in range(order, len(body)):
            for k in range(order + 1):
                if k < order or body[i - k:i] in deep:
                    counts[k][body[i - k:i]][body[i]] += 1

    def bits(context, byte, k):
        if k < 0:
            return 8.0
        seen = counts[k].get(context)
        if not seen:
            return bits(context[1:], byte, k - 1)
        total, distinct = sum(seen.values()), len(seen)
        if byte in seen:
            return -math.log2(seen[byte] / (total + distinct))
        return -math.log2(distinct / (total + distinct)) + bits(context[1:], byte, k - 1)

    def length(text):
        body = b"\n" * order + text.translate(LOWER).encode()
        return sum(bits(body[i - order:i], body[i], order) for i in range(order, len(body)))
    return length


def test_code_lengths_match_dictionaries(spark):
    rows = [r for r in sample(spark, 40) if r[2] in ("en", "fr", "de") and len(r[1]) < 4000][:12]
    trees = langid.train(frame(spark, rows + [(1, None, "en"), (2, "xyz", None)]))
    assert trees.languages == sorted({g for _, _, g in rows})
    texts = [t for _, t, _ in awkward() if t and len(t) < 6000] + [rows[0][1]]
    got = np.concatenate([trees.lengths(c) for c in chunks(pa.array(texts))])
    for i, g in enumerate(trees.languages):
        mine = [t for _, t, x in rows if x == g]
        body = [b"\n" * 3 + t.translate(LOWER).encode() for t in mine]
        contexts = Counter(b[j - 3:j] for b in body for j in range(3, len(b)))
        n = sum(contexts.values())
        length = ppm(mine, 3, {c for c, k in contexts.items() if k >= n / 65536})
        assert np.allclose(got[:, i], [length(t) for t in texts], rtol=1e-5)


def test_held_out_accuracy_and_awkward_rows(spark):
    rows = repeated(sample(spark, 200) + awkward())
    df = frame(spark, rows)
    held = f"{HELD_OUT_HASH.format(id='doc_id')} % 3 = 1"
    trees = langid.train(df.where(f"not ({held})"))
    out = langid.predict(df, trees, ["doc_id", "lang", "n", "first", "text"]).withColumn("held", langid.F.expr(held)).collect()
    assert len(out) == len(rows)
    planted = [r for r in out if r.held and r.doc_id < 1000]
    assert sum(r.lang == r.lang_pred for r in planted) / len(planted) >= 0.97
    for r in out:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and (letters or r.score == 0)


def test_nothing_to_learn_from(spark):
    df = frame(spark, [(1, "some text", None), (2, None, "en")])
    trees = langid.train(df)
    assert [(r.lang_pred, r.score) for r in langid.predict(df, trees, ["doc_id"]).collect()] == [("und", 0.0)] * 2
    assert langid.predict(df.limit(0), trees, ["doc_id"]).count() == 0


def test_sample_is_bounded(spark):
    df = frame(spark, sample(spark, 200))
    small = langid.train(df, sample_bytes=20_000, least_documents=1)
    whole = langid.train(df, sample_bytes=10 ** 9)
    assert small.languages and sum(map(len, small.strings)) < 0.75 * sum(map(len, whole.strings))


def test_every_language_is_learned_under_a_small_bound(spark):
    """Few long documents a language, one language with many: none is lost, and draws go in the order of the hashes."""
    rows = [(100 * g + i, f"{chr(97 + g)} word{g} " * 3000, f"l{g}") for g in range(12) for i in range(3)]
    rows += [(5000 + i, "many copies of one text", "many") for i in range(300)]
    df = frame(spark, rows)
    assert langid.train(df, sample_bytes=1000).languages == sorted({g for _, _, g in rows})
    keyed = df.withColumn("draw", langid.F.xxhash64("doc_id", "text")).select("text", "lang", "draw")
    by_language = defaultdict(list)
    for r in keyed.collect():
        by_language[r.lang].append((r.draw % 2 ** 64) >> 1)
    for size, least in ((1000, 20), (1, 1), (3000, 20)):
        got = Counter(r.lang for r in langid._drawn(keyed, size, least).collect())
        for g, draws in by_language.items():
            draws.sort()
            share = min(1.0, size / sum(len(t) for _, t, x in rows if x == g)) * 2.0 ** 63
            assert got[g] == sum(d <= max(share, draws[min(least, len(draws)) - 1]) for d in draws) >= min(least, len(draws))
