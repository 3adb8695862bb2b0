"""Personal data by native expressions: patterns propose spans, checksums confirm them, words nearby adjust their score.

Patterns match leftmost and do not overlap within a kind. They are written so that no text makes them slow: repetitions are
possessive where that changes nothing, and a run of characters is only entered at its start or where the last match ended. A match's place follows from
the pieces between the matches, whose lengths are summed up in blocks, so that many matches in a long text stay cheap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.documents import quoted

BLOCK = 128
NEAR = 40
LEAST_SCORE = 0.5
BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """pattern: in Java's dialect; valid: SQL over the match m; words: of the text before a span, raise its score."""

    name: str
    pattern: str
    valid: str
    score: float
    words: str
    always: bool = True


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Luhn: from the right, every second digit counts double, less nine if that has two digits.
_LUHN = (f"length({_DIGITS}) between 13 and 19 and aggregate(sequence(1, greatest(1, least(19, length({_DIGITS})))), 0, (s, i) -> s + "
         f"case when i % 2 = 1 then cast(substr(reverse({_DIGITS}), i, 1) as int) else cast(substr('0246813579', cast(substr(reverse({_DIGITS}), i, 1) as int) + 1, 1) as int) end) % 10 = 0")
# Mod-97: the first four characters go to the end, letters count from 10 on, the whole number leaves 1.
_MOD97 = ("aggregate(sequence(1, length(m)), 0, (s, i) -> case when substr(concat(substr(m, 5), substr(m, 1, 4)), i, 1) rlike '[0-9]' "
          "then (s * 10 + cast(substr(concat(substr(m, 5), substr(m, 1, 4)), i, 1) as int)) % 97 "
          "else (s * 100 + ascii(substr(concat(substr(m, 5), substr(m, 1, 4)), i, 1)) - 55) % 97 end) = 1")

BASE = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 0.9, "mail|write|contact|schreib|courriel|correo"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", rf"m rlike r'^{_PART}(\.{_PART}){{3}}$'", 0.6, "ip|address|host|server|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", _LUHN, 0.8, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15", 0.6, "phone|call|tel|mobile|anruf"),
]
ADDED = [
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", _MOD97, 0.9, "iban|account|bank|konto|compte|cuenta", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "not m rlike '^(000|666|9)' and not m rlike '-00-' and not m rlike '0000$'", 0.3, "ssn|social|security|taxpayer", False),
]


def _spans(kind: Kind) -> list[tuple[str, str]]:
    """Steps that end in an array of (start, end, score) per text, in code points."""
    n, words = kind.name, kind.words
    keep = f"({kind.valid})" if kind.always else f"({kind.valid}) and score >= {LEAST_SCORE}"
    more = "(a, v) -> concat(a, array(element_at(a, -1) + v))"
    return [
        (f"{n}_m", f"regexp_extract_all(_text, r'{kind.pattern}', 0)"),
        (f"{n}_p", f"case when size({n}_m) > 0 then split(_text, r'{kind.pattern}', -1) end"),
        (f"{n}_b", f"case when size({n}_m) > 0 then transform(sequence(0, (size({n}_m) - 1) div {BLOCK}), b -> transform(slice(arrays_zip({n}_p, {n}_m), b * {BLOCK} + 1, least({BLOCK}, size({n}_m) - b * {BLOCK})), "
                   f"x -> char_length(x.{n}_p) + char_length(x.{n}_m))) end"),
        (f"{n}_s", f"aggregate(transform({n}_b, x -> aggregate(x, 0, (a, v) -> a + v)), array(0), {more})"),
        (f"{n}_e", f"flatten(transform({n}_b, (x, b) -> slice(aggregate(x, array({n}_s[b]), {more}), 2, size(x))))"),
        (n, f"case when size({n}_m) > 0 then transform(filter(transform(slice(arrays_zip({n}_m, {n}_p, {n}_e), 1, size({n}_m)), x -> struct(x.{n}_m as m, x.{n}_e - char_length(x.{n}_m) as start, x.{n}_e as stop, "
            f"least(1D, {kind.score}D + if(lower(right(x.{n}_p, {NEAR})) rlike '{words}', {BONUS}D, 0D)) as score)), "
            f"x -> {_inside(keep)}), "
            f"x -> struct('{n}' as kind, x.start, x.stop, x.score)) else cast(array() as array<struct<kind:string,start:int,stop:int,score:double>>) end"),
    ]


def _inside(condition: str) -> str:
    """A condition over m and score as one over the struct x."""
    return re.sub(r"(?<![\w.'\[])(m|score)(?![\w'(\]])", r"x.\1", condition)


def _joined(array: str) -> str:
    return f"array_join(transform({array}, x -> concat(x.kind, ':', x.start, ':', x.stop)), ',')"


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of every row with a count per kind, base_sha256 (of the spans of the four base kinds), spans, and their scores.

    Spans are kind:start:end in code points, end exclusive, by kind, then start, joined by commas; scores has two decimals each, in the same order.
    The base kinds are email, ip, card and phone; added are iban (confirmed by mod-97) and ssn (only near words that speak of it). Kinds may
    overlap. A null or empty text has none. Rows are searched each for itself; an empty table gives an empty result.
    """
    out = docs.select(*(quoted(c).alias(f"_keep{i}") for i, c in enumerate(keep)), F.coalesce(quoted(text), F.lit("")).alias("_text"))
    steps = [_spans(k) for k in BASE + ADDED]
    for level in zip(*steps):
        out = out.withColumns({name: F.expr(sql) for name, sql in level})
    base, added = (", ".join(k.name for k in kinds) for kinds in (BASE, ADDED))
    every = f"concat({base}, {added})"
    return out.select(
        *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)),
        *(F.expr(f"cast(size({k.name}) as bigint)").alias(f"n_{k.name}") for k in BASE + ADDED),
        F.sha2(F.expr(_joined(f"concat({base})")), 256).alias("base_sha256"), F.expr(_joined(every)).alias("spans"),
        F.expr(f"array_join(transform({every}, x -> format_number(x.score, '0.00')), ',')").alias("scores"))
