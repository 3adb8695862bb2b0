import random
import re

from pyspark.sql import functions as F

from tabwright.llm import secret_scan as S
from tests.llm.fixtures import awkward, frame, repeated, sample

HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def planted():
    """Documents with one secret or one harmless long value each, and which it is."""
    rng, rows, kinds = random.Random(5), [], {}
    text = "some of the words that stand before it and go on for a while"
    for i in range(400):
        value = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
        made = [("password=" + value(HEX, 18), 1), ('token = "' + value(HEX, 40) + '"', 1), ("AKIA" + value(UPPER, 15) + "7", 1),
                (value("0123456789", 16), 0), ("commit " + value(HEX, 40), 0), ("the-version-of-the-words-" + str(i) + "-and-others", 0)][i % 6]
        rows.append((9000 + i, f"{text} {made[0]} {text}", "en"))
        kinds[9000 + i] = made[1]
    return rows, kinds


def test_proposals_match_python(spark):
    rows = sample(spark) + awkward() + planted()[0][:40] + [(8000, " ".join(f"{i}abcdefghijklmnopq/{i}==" for i in range(600)), "en"), (8001, "a" * 30000 + "1", "en"), (8002, "😀 é " + "x1" * 10, "en")]
    got = sorted((r.doc_id, r.start, r.stop, r.value, r.before) for r in S.proposals(frame(spark, rows)).collect())
    want = []
    for d, t, _ in rows:
        last = 0
        for m in re.finditer(S.PROPOSAL, t or ""):
            want.append((d, m.start(), m.end(), m.group(), t[last:m.start()][-40:]))
            last = m.end()
    assert got == sorted(want) and len([w for w in want if w[0] == 8000]) == 600


def test_forest_removes_false_findings_it_has_not_seen(spark):
    rows, kinds = planted()
    df = frame(spark, sample(spark, 40) + rows)
    found = S.with_features(S.proposals(df), S.sequences(df))
    truth = spark.createDataFrame([(k, float(v)) for k, v in kinds.items()], "of long, label double")
    labelled = found.join(truth, F.col("of") == F.col("doc_id")).where("doc_id % 7 < 3")
    got = {r.doc_id: r.is_secret for r in S.scan(df, findings=labelled).collect() if r.doc_id in kinds}
    held_out = [d for d in got if d % 7 >= 3]
    assert len(held_out) > 150 and sum(got[d] == bool(kinds[d]) for d in held_out) / len(held_out) >= 0.97
    # without labelled findings the obvious ones teach the same
    own = {r.doc_id: r.is_secret for r in S.scan(df).collect() if r.doc_id in kinds}
    assert sum(own[d] == bool(kinds[d]) for d in own) / len(own) >= 0.97


def test_native_and_awkward(spark):
    rows = repeated(sample(spark, 20) + awkward())
    df = S.scan(frame(spark, rows + [(None, "password=0123456789abcdef01", None)]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert {r.doc_id: r.is_secret for r in df.collect()}.get(None) is True
    assert S.scan(frame(spark, rows).limit(0)).count() == 0


def test_values_behind_names_match_python(spark):
    rng, rows = random.Random(9), []
    names = ["password", "PWD", "api_key", "apikey", "Access-Key", "secret_id", "tokens", "private-key_key", "credential", "word", "auth", "postgres://joe:", "http://a:b:", "://:"]
    between = ["=", ":", ":=", "=>", "==", ' = "', '": "', "\t:\t'", "  =  ", " " * 8 + "=" + " " * 8, " " * 9 + "=", "=" + " " * 9, " ", "", "=:", '"" =']
    values = ["abcdef", "abcde", "s3cret-Value/9", "=abcdefg", "pa55w@host", "eyJabcdef.eyJabcdef.zz", "a:b=c:d=e", "[abcdef]", "é漢字😀xyz", "x\u00a0yzxyz", "ſecret=abcdefg", "token=abcdefg"]
    for i in range(3000):
        rows.append((i, " ".join(rng.choice(names) + rng.choice(between) + rng.choice(values) + rng.choice(["", "\n", "'", '"']) for _ in range(rng.randint(1, 4))), "en"))
    got = sorted((r.doc_id, r.start, r.stop, r.value) for r in S.proposals(frame(spark, rows)).collect())
    assert got == sorted((d, m.start(), m.end(), m.group()) for d, t, _ in rows for m in re.finditer(S.PROPOSAL, t, re.ASCII))
    assert len(got) > 2000 and {"eyJabcdef.eyJabcdef.zz", "pa55w", "a:b=c:d=e", "s3cret-Value/9", "é漢字😀xyz"} <= {v for *_, v in got}
