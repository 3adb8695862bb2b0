import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm import line_dedup as L
from tests.llm.fixtures import awkward, frame, repeated, sample, words


def brute(rows):
    """The same rule with dictionaries: first holders of lines and line pairs, then one alignment per pair of documents."""
    lines = {d: (t or "").split("\n") if t else [] for d, t, _ in rows}
    strip = {d: [" ".join([x.strip("\x20\t\n\x0b\x0c\r")]) for x in v] for d, v in lines.items()}
    n = {d: [len(words(x)) for x in v] for d, v in strip.items()}
    keys = {}
    for d in sorted(lines):
        own = [((x,), k) for x, k in zip(strip[d], n[d]) if k] + [((strip[d][i], strip[d][i + 1]), n[d][i] + n[d][i + 1]) for i in range(len(n[d]) - 1) if n[d][i] and n[d][i + 1]]
        keys[d] = {x for x, k in own if k >= L.LINE_WORDS}
    owner, out = {}, {}
    for d in sorted(lines):
        gone = set()
        for a in {owner[k] for k in keys[d] if k in owner}:
            gone |= set(L.common_blocks([x or 0 for x in strip[a]], [x or 0 for x in strip[d]], n[d], L.BLOCK_WORDS))
        for k in keys[d]:
            owner.setdefault(k, d)
        text = dict((x[0], x[1]) for x in rows)[d]
        out[d] = (len(lines[d]), sorted(gone), text if not gone else "\n".join(x for i, x in enumerate(lines[d]) if i not in gone))
    return out


def planted():
    rng = random.Random(3)
    lines = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(90)) for _ in range(12)) for _ in range(60)]
    return [(3000, "\n".join(lines[:20]), "en"), (3001, "\n".join(lines[10:30]), "en"), (3002, "\n".join(lines[:20]), "en"), (3003, "\n".join([lines[50], *lines[12:18], lines[51]]), "en"),
            (3004, "\n".join(["  " + lines[40], "", lines[41], lines[3]]), "en"), (3005, "\n".join([lines[41], lines[40]]), "en"), (3006, "short one\n" + lines[42], "en"), (3007, "short one\n" + lines[43], "en")]


def test_matches_brute_force(spark):
    rows = sample(spark) + awkward() + planted()
    got = {r.doc_id: (r.n_lines, list(r.removed), r.text) for r in L.dedup_lines(frame(spark, rows)).collect()}
    want = brute(rows)
    assert got == want
    assert got[3002][2] == "" and got[3000][1] == [] and got[3006][1] == got[3007][1] == []
    # the first holder keeps what it has, so every long line is still somewhere
    before = {x.strip() for _, t, _ in rows for x in (t or "").split("\n") if len(words(x)) >= L.BLOCK_WORDS}
    after = {x.strip() for v in got.values() for x in (v[2] or "").split("\n")}
    assert before <= after


def test_repeated_ids_and_empty_table(spark):
    rows = sample(spark, 10) + awkward()
    got = L.dedup_lines(frame(spark, repeated(rows))).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _, _ in rows)
    assert L.dedup_lines(frame(spark, rows).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns_equal_lines_in_order(a, b):
    got = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    if a == b:
        assert len(got) == len(a)


def common_runs(a, b, n_words, least):
    """Every pair of places, as far as both go on alike; lines without words left out."""
    gone, b = set(), [(j, x) for j, x in enumerate(b) if n_words[j]]
    a = [x for x in a if x]
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k][1]:
                k += 1
            if sum(n_words[p] for p, _ in b[j:j + k]) >= least:
                gone |= {p for p, _ in b[j:j + k]}
    return gone


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_blocks_are_all_common_runs(a, b):
    n_words = [[0, 9, 3, 4, 5, 1][x] for x in b]
    got = L.common_blocks(a, b, n_words, 8)
    assert {j for j in got if n_words[j]} == common_runs(a, b, n_words, 8)


def test_lines_that_repeat_or_stand_in_another_order_go():
    x, y, z = "xyz"
    assert L.common_blocks([x, y], [y, x], [9, 9], 8) == [0, 1]
    assert L.common_blocks([z, x, z], [x, y, x], [9, 9, 9], 8) == [0, 2]
    assert L.common_blocks([x, y, x, z], [z, y, x], [9, 9, 9], 8) == [0, 1, 2]
    assert L.common_blocks([x, 0, y], [z, x, y, z, x, y], [4, 4, 4, 4, 4, 4], 8) == [1, 2, 4, 5]


def brute_runs(rows):
    """Every pair of documents, without any candidates: the lines with words in common runs."""
    strip = {d: [x.strip("\x20\t\n\x0b\x0c\r") for x in (t or "").split("\n")] for d, t, _ in rows}
    out = {}
    for d, b in strip.items():
        n = [len(words(x)) for x in b]
        out[d] = set().union(*(common_runs(a, b, n, L.BLOCK_WORDS) for e, a in strip.items() if e < d))
    return out


def test_blocks_of_short_lines_from_different_first_holders(spark):
    p1, p2, p3 = "one two three four five", "six seven eight nine ten", "uno dos tres"
    rows = [(1, p1 + "\nF", "en"), (2, p2 + "\nG", "en"), (3, f"{p1}\n\n{p2}", "en"), (4, f"{p1}\n\n{p2}", "en"), (5, f"{p1}\n{p2}", "en"),
            (11, "a b c\nd e f\nx", "en"), (12, "d e f\n" + p3, "en"), (13, "a b c\nd e f\n" + p3, "en"), (14, "k\na b c\nd e f\n" + p3, "en")]
    rng = random.Random(8)
    short = [" ".join(f"w{k}_{i}" for i in range(n)) for k, n in enumerate([0, 0, 1, 2, 3, 3, 4, 5, 7, 9])]
    rows += [(100 + d, "\n".join(rng.choice(short) for _ in range(rng.randrange(9))), "en") for d in range(60)]
    rows += planted() + awkward()[:9]
    got = {r.doc_id: r for r in L.dedup_lines(frame(spark, rows)).collect()}
    assert got[4].text == "" and got[5].text == "" and got[14].text == "k" and got[3].n_removed == got[13].n_removed == 0
    text = {d: (t or "").split("\n") for d, t, _ in rows}
    assert {d: {j for j in r.removed if words(text[d][j])} for d, r in got.items()} == brute_runs(rows)
