from collections import Counter

from tabwright.llm import quality_rules as Q
from tests.llm.fixtures import awkward, frame, repeated, sample, words


def brute(text):
    w = words(text, low=False)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) for k in range(3) if windows[(w[i], w[i + 1], w[i + 2])] > 1}
    n = len(w)
    base = (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))
    failed = n < 50 or 100 * base[4] > 50 * n
    lettered = sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in x) for x in w)
    good = (2 * n <= base[1] <= 15 * n and 10 * base[2] <= n and 2 * base[3] <= len(lines) and 10 * lettered >= 8 * n
            and 10 * max(Counter(w).values(), default=0) <= 3 * n and 20 * len(set(w)) >= n)
    return (*base, failed, not failed and good)


PLANTED = ["*** " * 60 + "a b c", " ".join(f"w{i}" for i in range(60)), "| ".join(f"word{i}" for i in range(80)), "\n".join(["the same line again"] * 3 + [f"line number {i} of many others" for i in range(30)]),
           " ".join(str(i) for i in range(100)), " ".join(["of"] * 40 + [f"x{i}y" for i in range(60)]), "word " * 2000, " ".join(f"{'long' * 6}{i}" for i in range(60)),
           "\n".join(f"{'ab' if i % 2 else 'cd'}" for i in range(60)) + " " + " ".join(f"q{i}" for i in range(99)), "a b c " * 17]


def test_matches_python_in_any_order(spark):
    rows = sample(spark, 200) + awkward() + [(7000 + i, t, "en") for i, t in enumerate(PLANTED)]
    want = {d: brute(t) for d, t, _ in rows}
    df = frame(spark, rows)
    for rules in (Q.RULES, dict(reversed(Q.RULES.items()))):
        got = Q.judge(df, ["doc_id"], rules=rules).collect()
        assert {r.doc_id: tuple(r)[1:-1] for r in got} == want
    assert any(v[-1] for v in want.values()) and len({r.rejected_by for r in got}) > 4


def test_plan_orders_by_rejection_per_cost(spark):
    slow = lambda t, docs: Q._by_word(t, docs)[0][:0].sum() + (t.n_words[docs] < 0)
    plan = Q.plan(frame(spark, sample(spark, 200)), rules={"never": slow, **Q.RULES})
    gain = [share / max(cost, 1e-12) for _, cost, share in plan]
    assert gain == sorted(gain, reverse=True) and len(plan) == 7
    assert Q.plan(frame(spark, []))[0][1:] == (0.0, 0.0)


def test_each_row_for_itself(spark):
    rows = repeated(sample(spark, 5) + awkward())
    assert Q.judge(frame(spark, rows), ["doc_id", "n", "first"]).count() == len(rows)
    assert Q.judge(frame(spark, rows).limit(0), ["doc_id"]).count() == 0
