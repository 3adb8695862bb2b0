import hashlib
import random

import pytest

from tabwright.llm import suffix_dedup as S
from tests.llm.fixtures import awkward, frame, repeated, sample


def brute(rows, length=100):
    seen, out = set(), {}
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        body = (t or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            s = body[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d] = (len(body), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(body, gone) if not g)).hexdigest())
    return out


def planted():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh éü") for _ in range(n))
    passage, edge = text(160), text(99)
    rows = [(6000 + i, text(60) + passage + text(50 + i), "en") for i in range(30)]
    rows += [(6100, "ab" * 300, "en"), (6101, "ab" * 100 + "x" + "ba" * 120, "en"), (6102, edge + "1", "en"), (6103, "2" + edge + "3", "en"), (6104, text(300), "en")]
    twice = text(250)
    return rows + [(6105, twice + text(30) + twice, "en"), (6106, passage[:100], "en"), (6107, passage[1:100], "en"), (6108, "\x00" * 500, "en"), (6109, "漢字" * 120, "en")]


@pytest.mark.parametrize("length, seed", [(100, 36), (100, 100), (40, 8)])
def test_matches_brute_force(spark, length, seed):
    rows = sample(spark, 60) + [r for r in awkward() if len(r[1] or "") < 10_000] + planted()
    out = S.remove_repeats(frame(spark, rows), length=length, seed=seed).collect()
    want = brute(rows, length)
    assert {r.doc_id: tuple(r)[1:5] for r in out} == want and sum(v[1] > 0 for v in want.values()) > 30
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in out)


def test_long_texts_repeated_ids_and_empty_table(spark):
    rows = awkward()
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeats(frame(spark, repeated(rows)), with_kept=False).collect()}
    assert got == brute(rows)
    assert S.remove_repeats(frame(spark, rows).limit(0)).count() == 0
