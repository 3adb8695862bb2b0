"""Strings of structure must not share a hash, and what follows from it in the operators."""

import numpy as np
import pytest

from tabwright.llm import bytesvec, hyperminhash, line_dedup, quality_rules
from tests.llm.fixtures import frame


def thue_morse(n, letters="ab"):
    """A string and its opposite: every byte differs, polynomial hashes modulo a power of two agree."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


@pytest.mark.parametrize("n", [64, 128, 256, 512, 1024, 2048, 4096, 8192])
def test_structured_strings_and_runs(n):
    for letters in ("ab", "0z", " ~", "aA"):
        a, b = thue_morse(n, letters)
        buf = np.frombuffer((a + b + a).encode(), np.uint8)
        starts = np.array([0, n, 2 * n])
        first, second, third = bytesvec.segment_hash(bytesvec.prefix_hash(buf), starts, starts + n, buf)
        assert first == third != second
    bits = np.array([bin(i).count("1") % 2 for i in range(n)])
    for low, high in ((3, 10), (1, 1 << 40)):
        keys = np.where(np.concatenate([bits, 1 - bits, bits]) == 1, np.uint64(high), np.uint64(low))
        first, second, third = bytesvec.run_hash(keys, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
        assert first == third != second


def test_equal_strings_are_equal_wherever_they_stand():
    rng = np.random.default_rng(2)
    for n in (1, 255, 256, 257, 5000):
        text = rng.integers(97, 123, n).astype(np.uint8)
        buf = np.concatenate([text, [32], rng.integers(97, 123, 77).astype(np.uint8), [32], text])
        starts = np.array([0, n + 79])
        a, b = bytesvec.segment_hash(bytesvec.prefix_hash(buf), starts, starts + n, buf)
        assert a == b


def test_operators_tell_structured_texts_apart(spark):
    a, b = thue_morse(2048)
    rows = [(1, f"{a}\n{b}", "en"), (2, a, "en"), (3, b, "en"), (4, " ".join(f"w{i}" for i in range(60)) + f"\n{a} one two three four five six seven", "en"),
            (5, " ".join(f"v{i}" for i in range(60)) + f"\n{b} one two three four five six seven", "en")]
    judged = {r.doc_id: r for r in quality_rules.judge(frame(spark, rows), ["doc_id"]).collect()}
    assert judged[1].n_dup_lines == 0
    groups = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(frame(spark, rows), shingle=2, percent=80).collect()}
    assert groups[2] == 2 and groups[3] == 3
    kept = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert set(kept.values()) == {0}
