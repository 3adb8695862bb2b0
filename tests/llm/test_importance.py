import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from tabwright.llm import importance as I
from tests.llm.fixtures import LOWER, awkward, frame, repeated, sample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    docs = [(d, *features(t, longest, buckets)) for d, t, _ in rows]
    S, T = Counter(x for _, _, f in docs for x in f), Counter(x for t in target for x in features(t, longest, buckets)[1])
    s, t = sum(S.values()), sum(T.values())
    out = []
    for d, n, f in docs:
        gains = [math.floor(1000 * math.log((T[x] + 1) * (s + buckets) / ((S[x] + 1) * (t + buckets)))) for x in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def run(df, target, **how):
    return sorted((tuple(r) for r in I.resample(df, target, **how).collect()), key=repr)


def benchmark(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    return df, [r.text for r in df.collect()]


def test_matches_python(spark):
    rows = sample(spark) + awkward()
    target, texts = benchmark(spark)
    assert run(frame(spark, rows), target) == brute(rows, texts)
    for head in (1, 50, 5000):  # the head only decides how a bucket is worked out
        assert run(frame(spark, rows), target, longest=3, buckets=64, percent=50, least_words=1, head=head) == brute(rows, texts, 3, 64, 50, 1)


def test_repeated_rows_null_ids_and_nothing(spark):
    rows = [r for r in repeated(sample(spark, 30) + awkward()) if r[0] is not None] + [(None, "a text without an id " * 10, "en"), (None, None, "en")]
    target, texts = benchmark(spark)
    assert run(frame(spark, rows), target, percent=100) == brute(rows, texts, percent=100)
    assert I.resample(frame(spark, []), target).count() == 0
    assert run(frame(spark, rows), target.limit(0), percent=30, seed=7) == brute(rows, [], percent=30, seed=7)
    assert run(frame(spark, [(1, None, "en"), (2, " ., ", "en")]), target) == brute([(1, None, ""), (2, " ., ", "")], texts)


def test_states_continue():
    texts = [b"", b"a", b"word", bytes(range(256)), b"x" * 63, b"y" * 64, b"z" * 65, b"long" * 5000]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    for before in (b"", b"before "):
        states = np.full(len(texts), zlib.crc32(before), np.uint32)
        assert I.extend(states, buf, starts, ends).tolist() == [zlib.crc32(before + t) for t in texts]


def test_head_is_exact_and_bounded(spark):
    rows = sample(spark)
    df = frame(spark, rows).select("text")
    head = I.learn_head(df, longest=2, head=100)
    words = head.words.to_pylist()
    assert 0 < len(words) <= 100 and 0 < len(head.pairs) <= 100
    assert head.states.tolist() == [zlib.crc32(w) for w in words]
    assert head.pair_states.tolist() == [zlib.crc32(words[p // len(words)] + b" " + words[p % len(words)]) for p in head.pairs]
    counts = Counter(w for _, t, _ in rows for w in WORD.findall((t or "").translate(LOWER)))
    assert {w for w, n in counts.items() if 100 * n > 2 * sum(counts.values())} <= {w.decode() for w in words}
