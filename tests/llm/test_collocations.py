import re
from collections import Counter, defaultdict

from tabwright.llm import collocations as C
from tests.llm.fixtures import LOWER, awkward, frame, repeated, sample


def pieces(text):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", p)


def brute(rows, longest=3, least=10, inside=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        g = "und" if lang is None else lang
        for w in pieces(text):
            n[g] += len(w)
            for k in range(1, longest + 1):
                f[g].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for g in f:
        candidates = {p: a for p, a in f[g].items() if len(p) > 1 and a >= least}
        covered = Counter()
        for q, b in candidates.items():
            for s in range(2, len(q)):
                for i in range(len(q) - s + 1):
                    covered[q[i:i + s]] = max(covered[q[i:i + s]], b)
        best = []
        for p, a in candidates.items():
            if not covered[p] or 100 * covered[p] < inside * a:
                score, k = min((1_000_000 * a * a // (f[g][p[:k]] * f[g][p[k:]]), k) for k in range(1, len(p)))
                best.append((score, a, " ".join(p), f[g][p[:k]], f[g][p[k:]]))
        best.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(g, i + 1, x[2], x[1], x[3], x[4], n[g], x[0]) for i, x in enumerate(best[:top])]
    return sorted(out)


def run(df, **how):
    return sorted(tuple(r) for r in C.collocations(df, **how).collect())


def test_matches_python(spark):
    rows = repeated(sample(spark) + awkward())
    df = frame(spark, rows)
    assert run(df, least=3) == brute(rows, least=3)
    assert run(df, longest=4, least=2, inside_percent=80, top=40, period=3) == brute(rows, 4, 2, 80, 40)
    assert run(df, longest=2, least=4) == brute(rows, 2, 4)


def test_triggers_on_every_word_and_hot_passages(spark, monkeypatch):
    monkeypatch.setattr(C, "FLUSH_ROWS", 50)
    hot = "new york is new york , new york city and\ta  New  York\nminute ; a a a a a a a"
    rows = [(i, hot if i % 3 == 0 else f"{hot} tail{i} ends here", "en" if i % 2 else None) for i in range(90)]
    for period in (1, 2, 1000):
        assert run(frame(spark, rows), least=5, period=period) == brute(rows, least=5)
    assert any(r[2] == "a a a" for r in brute(rows, least=5))


def test_every_word_belongs_to_one_chunk(spark):
    rows = sample(spark) + awkward()
    total = sum(len(w) for _, t, _ in rows for w in pieces(t))
    for period in (1, 5, 64):
        dictionary = C.parse(frame(spark, rows), period=period).collect()
        assert sum(r.n * (sum(len(w) for w in pieces(bytes(r.chunk).decode())) - r.tail) for r in dictionary) == total
        assert len({(r.lang, r.tail, bytes(r.chunk)) for r in dictionary}) == len(dictionary)
    assert {r.tail for r in dictionary} == {0, 2}


def test_equal_passages_are_cut_alike(spark):
    passage = " ".join(f"word{i * 31 % 97}" for i in range(400))
    one = C.parse(frame(spark, [(1, passage, "en")]), period=8).count()
    many = C.parse(frame(spark, [(i, f"start{i} {passage} end{i}", "en") for i in range(50)]), period=8).count()
    assert many < one + 4 * 50


def test_large_products(spark):
    number = "cast({} as decimal(15,0))"
    row = spark.sql(f"select (cast(1000000 as decimal(7,0)) * {number.format(999999999999999)} * {number.format(999999999999999)}) div ({number.format(999999999999998)} * {number.format(999999999999999)}) as s").first()
    assert row.s == 1_000_000 * 999999999999999 ** 2 // (999999999999998 * 999999999999999)


def test_nothing_to_count(spark):
    assert run(frame(spark, [])) == [] and run(frame(spark, [(1, None, None), (2, "", "en"), (3, " . ,", "de"), (4, "a b", "fr")])) == []
