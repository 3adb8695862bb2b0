import hashlib
import re

from tabwright.llm import pii
from tests.llm.fixtures import awkward, frame, repeated, sample

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "iban":
        return int("".join(str(int(c, 36)) for c in m[4:] + m[:4])) % 97 == 1
    if kind == "ssn":
        return m[:3] not in ("000", "666") and m[0] != "9" and m[4:6] != "00" and m[7:] != "0000"
    return True


def brute(text):
    text = text or ""
    out = {}
    for kind in pii.BASE + pii.ADDED:
        last, spans = 0, []
        for m in re.finditer(PATTERNS[kind.name], text):
            score = min(1, kind.score + (pii.BONUS if re.search(kind.words, text[last:m.start()][-pii.NEAR:].lower()) else 0))
            last = m.end()
            if valid(kind.name, m.group()) and (kind.always or score >= pii.LEAST_SCORE):
                spans.append((f"{kind.name}:{m.start()}:{m.end()}", f"{score:.2f}"))
        out[kind.name] = spans
    base = [s for k in pii.BASE for s, _ in out[k.name]]
    every = [s for v in out.values() for s in v]
    return tuple(len(v) for v in out.values()) + (hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(s for s, _ in every), ",".join(x for _, x in every))


PLANTED = [
    "a@b.c+d@e.f x@@y.z q@-.-. .@a.b %@x.y.", "😀é me@x.org, you@y.co.uk! mail: z@z.z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 9.9.9.9.9", "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005",
    "+49 (0)30 123456-78 call +1.2 +123456789 ++44 20 7946 0958 +1(((", "IBAN DE89370400440532013000 GB82WEST12345698765432 DE89370400440532013001", "social security 123-45-6789 and 987-65-4321, 078-05-1120",
    "x" * 20000 + "@" + "y" * 10 + "." + "z" * 20000, "a@" + "b." * 5000, "1" * 30000, "1 " * 3000, "+1 " + "(" * 20000, " ".join(f"u{i}@h{i}.net" for i in range(700)), "@", "0" * 16, "+0000000000"]


def test_matches_python(spark):
    rows = sample(spark) + awkward() + [(5000 + i, t, "en") for i, t in enumerate(PLANTED)] + [(None, PLANTED[0], None)]
    df = pii.find(frame(spark, rows), ["doc_id", "n", "words"])
    got = {r.doc_id: tuple(r)[3:] for r in df.collect()}
    assert got == {d: brute(t) for d, t, _ in rows}
    assert len(got[5012]) and got[5012][0] == 700
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_each_row_for_itself(spark):
    rows = repeated(sample(spark, 5) + awkward())
    assert pii.find(frame(spark, rows), ["doc_id"]).count() == len(rows)
    assert pii.find(frame(spark, rows).limit(0), ["doc_id"]).count() == 0
