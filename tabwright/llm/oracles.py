"""SQL that must give the same rows as the queries that SQL can express, each by plain means."""

from __future__ import annotations

_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 0.9, "mail|write|contact|schreib|courriel|correo"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda y: y::hugeint)) <= 255", 0.6, "ip|address|host|server|adresse"),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             "length(d) between 13 and 19 and list_sum(list_transform(range(1, length(d) + 1), lambda i: case when i % 2 = 1 then substr(reverse(d), i, 1)::int "
             "else (2 * substr(reverse(d), i, 1)::int) // 10 + (2 * substr(reverse(d), i, 1)::int) % 10 end)) % 10 = 0", 0.8, "card|visa|credit|karte|carte|tarjeta"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) between 9 and 15", 0.6, "phone|call|tel|mobile|anruf"),
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
             "list_reduce(list_transform(string_split(array_to_string(list_transform(string_split(m[5:] || m[1:4], ''), "
             "lambda c: case when c between '0' and '9' then c else (ascii(c) - 55)::varchar end), ''), ''), lambda c: c::int), lambda a, v: (a * 10 + v) % 97) = 1 and score >= 0.5",
             0.9, "iban|account|bank|konto|compte|cuenta"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "m[1:3] not in ('000', '666') and m[1] <> '9' and m[5:6] <> '00' and m[8:11] <> '0000' and score >= 0.5", 0.3, "ssn|social|security|taxpayer"),
}


def _found(place: int, kind: str) -> str:
    pattern, valid, score, words = _KINDS[kind]
    return f"""
    select doc_id, {place} as place, '{kind}' as kind, start, stop, score from (
      select *, least(1.0, {score} + case when regexp_matches(lower(right(p, 40)), '{words}') then 0.3 else 0 end) as score from (
        select doc_id, m, p, regexp_replace(m, '[^0-9]', '', 'g') as d, stop - length(m) as start, stop from (
          select doc_id, ms[i] as m, ps[i] as p, list_sum(list_transform(ps[1:i], lambda y: length(y))) + list_sum(list_transform(ms[1:i], lambda y: length(y))) as stop from (
            select doc_id, ms, ps, unnest(range(1, len(ms) + 1)) as i from (
              select doc_id, regexp_extract_all(text, '{pattern}') as ms, string_split_regex(text, '{pattern}') as ps from documents where text is not null)))))
    where {valid}"""


PII = f"""
with spans as ({" union all ".join(_found(i, k) for i, k in enumerate(_KINDS))}),
per as (select doc_id, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in _KINDS)},
          string_agg(kind || ':' || start || ':' || stop, ',' order by place, start) filter (place < 4) as base,
          string_agg(kind || ':' || start || ':' || stop, ',' order by place, start) as spans,
          string_agg(format('{{:.2f}}', score::double), ',' order by place, start) as scores from spans group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _KINDS)}, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(scores, '') as scores
from documents left join per using (doc_id)"""

# Words and lines as lists; a window of three words repeats if its text is found twice or more.
QUALITY = r"""
with w as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, i, words[i:i+2] as g from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)
), twice as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1
), inside as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id
), per_word as (
  select doc_id, count(*) as k from (select doc_id, unnest(words) as x from w) group by doc_id, x
), top as (
  select doc_id, max(k) as most, count(*) as distinct_words from per_word group by doc_id
), counts as (
  select w.doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(lines) as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(inside.n, 0)::bigint as n_repeat_words,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as lettered, coalesce(most, 0) as most, coalesce(distinct_words, 0) as distinct_words
  from w left join inside using (doc_id) left join top using (doc_id)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars between 2 * n_words and 15 * n_words and 10 * n_symbols <= n_words and 2 * n_dup_lines <= n_lines
       and 10 * lettered >= 8 * n_words and 10 * most <= 3 * n_words and 20 * distinct_words >= n_words as kept
from judged"""

# All pairs with a shingle in common, then whatever is reachable.
NEAR = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), sets as (
  select distinct doc_id, case when len(words) = 1 then words else words[i:i+1] end as g
  from (select doc_id, words, unnest(range(1, greatest(len(words), 2))) as i from w where len(words) > 0)
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from sets x join sets y on x.g = y.g and x.doc_id <> y.doc_id group by all)
  join sizes s on s.doc_id = a join sizes t on t.doc_id = b where 100 * c >= 80 * (s.n + t.n - c)
), reached as (
  select a as doc_id, a as r from links union select reached.doc_id, links.b from reached join links on links.a = reached.r
), least_ as (
  select doc_id, min(r) as component_id from reached group by doc_id
)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id, d.doc_id = coalesce(component_id, d.doc_id) as kept
from documents d left join sizes using (doc_id) left join least_ using (doc_id)"""

# Every string of 100 bytes by itself, as hexadecimal text.
REPEATS = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, length(hex(encode(coalesce(text, '')))) // 2 as n from documents
), starts as (
  select doc_id, p, substr(h, (2 * p + 1)::bigint, 200) as s from (select doc_id, h, unnest(range(0, n - 99)) as p from d)
), repeats as (
  select doc_id, p from starts qualify row_number() over (partition by s order by doc_id, p) > 1
), edges as (
  select doc_id, p, case when p <= lag(p) over (partition by doc_id order by p) + 100 then 0 else 1 end as new from repeats
), runs as (
  select doc_id, p, sum(new) over (partition by doc_id order by p) as run from edges
), spans as (
  select doc_id, min(p) as a, max(p) + 100 as b from runs group by doc_id, run
), per as (
  select doc_id, list(a order by a) as a, list(b order by a) as b, sum(b - a)::bigint as removed, count(*) as k from spans group by doc_id
)
select doc_id, n as n_bytes, coalesce(removed, 0) as n_removed, coalesce(k, 0) as n_spans,
  sha256(unhex(case when k is null then h else array_to_string(list_transform(range(0, k + 1), lambda i: substr(h, (2 * (case when i = 0 then 0 else b[i] end) + 1)::bigint,
    (2 * ((case when i = k then n else a[i + 1] end) - (case when i = 0 then 0 else b[i] end)))::bigint)), '') end)) as kept_sha256
from d left join per using (doc_id)"""

# All phrases of up to three words by plain counting; products as hugeint.
PHRASES = r"""
with pieces as materialized (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(ps) as piece from (
      select lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps from documents))
), grams as (
  select lang, 1 as size, unnest(w) as phrase from pieces
  union all select lang, 2, array_to_string(w[i:i+1], ' ') from (select lang, w, unnest(range(1, len(w))) as i from pieces)
  union all select lang, 3, array_to_string(w[i:i+2], ' ') from (select lang, w, unnest(range(1, len(w) - 1)) as i from pieces)
), f as materialized (
  select lang, size, phrase, count(*) as f from grams group by all
), n as (
  select lang, sum(f)::bigint as n from f where size = 1 group by lang
), candidates as materialized (
  select lang, size, phrase, string_split(phrase, ' ') as w, f as a from f where size > 1 and f >= 10
), halves as materialized (
  select lang, phrase, a, k, lang || chr(10) || array_to_string(w[1:k], ' ') as p, lang || chr(10) || array_to_string(w[k+1:], ' ') as q from (select *, unnest(range(1, size)) as k from candidates)
), keyed as materialized (
  select lang || chr(10) || phrase as key, f from f
), cuts as (
  select h.lang, h.phrase, h.a, h.k, x.f as l, y.f as r, (1000000::hugeint * h.a * h.a) // (x.f::hugeint * y.f) as score
  from halves h join keyed x on x.key = h.p join keyed y on y.key = h.q
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), covered as (
  select lang, phrase, max(a) as most from (select lang, a, array_to_string(w[i:i+1], ' ') as phrase from (select *, unnest([1, 2]) as i from candidates where size = 3)) group by all
)
select l.lang, row_number() over (partition by l.lang order by score desc, a desc, encode(l.phrase)) as rank, l.phrase, a, l.l, l.r, n, score::bigint as score
from lowest l join n on n.lang = l.lang left join covered c on c.lang = l.lang and c.phrase = l.phrase
where most is null or 100 * most < 50 * a
qualify rank <= 2000"""

# CRC-32 of every different word, byte by byte over the usual table, which is made by its rule.
_CRC_STEP = "case when {x} % 2 = 1 then xor({x} // 2, 3988292384) else {x} // 2 end"
RESAMPLED = r"""
with recursive steps as (
  select i::bigint as i, i::bigint as v, 0 as round from range(256) t(i)
  union all select i, """ + _CRC_STEP.format(x="v") + r""", round + 1 from steps where round < 8
), crc_table as (
  select list(v order by i) as t from steps where round = 8
), d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), words as (
  select doc_id, unnest(w) as x from d
), wanted as (
  select unnest(w) as x from b
), per as (
  select doc_id, x, count(*) as k from words group by all
), places as (
  select x, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, strlen(x) + 1), lambda i: ('0x' || substr(hex(encode(x)), 2 * i - 1, 2))::bigint)),
    lambda c, y: xor(c // 256, t[xor(c, y) % 256 + 1])), 4294967295) % 10000 as bucket
  from (select x from words union select x from wanted), crc_table
), s as (
  select bucket, sum(k) as s from per join places using (x) group by bucket
), t as (
  select bucket, count(*) as t from wanted join places using (x) group by bucket
), gain as (
  select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from words) + 10000) / ((coalesce(s, 0) + 1)::double * ((select count(*) from wanted) + 10000)))) as gain
  from (select distinct bucket from places) left join s using (bucket) left join t using (bucket)
), weights as (
  select doc_id, floor(sum(k * gain)::double / sum(k))::bigint as weight from per join places using (x) join gain using (bucket) group by doc_id
), scored as (
  select doc_id, len(w) as n_features, coalesce(weight, 0) as weight, len(w) >= 20 as able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from d left join weights using (doc_id)
), ranked as (
  select *, row_number() over (partition by able order by score desc, doc_id) as r, count(*) over (partition by able) as n from scored
)
select doc_id, n_features::bigint as n_features, weight, score, case when able and r <= 10 * n // 100 then r end as rank from ranked"""
