"""The corpus queries that SQL can state, for another engine over the same tables.

The others train, tokenize, align, search by index or add floating-point numbers; the
tests hold those against brute force.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _secret_spans() -> str:
    quote = "[\"'']?"
    kinds = [
        ("assign", f"(?i:(password|passwd|secret|token|api_?key){quote}\\x20*[:=]\\x20*{quote}([A-Za-z0-9+/_.=-]+))", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20),
        ("hex", "[0-9a-f]+", 0, 24),
        ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
        ("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]+", 0, 0),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ]
    parts = []
    for number, (kind, pattern, group, least) in enumerate(kinds):
        parts.append(
            f"""
            select doc_id, row, {number} as number, '{kind}' as kind, gaps, hits, part, {least} as least,
              unnest(range(1, len(hits) + 1)) as k
            from (select doc_id, row, string_split_regex(text, '{pattern}') as gaps,
                         regexp_extract_all(text, '{pattern}') as hits,
                         regexp_extract_all(text, '{pattern}', {group}) as part from texts)"""
        )
    return " union all ".join(parts)


OP4 = f"""
with texts as (select doc_id, coalesce(text, '') as text, row_number() over () as row from documents),
found as ({_secret_spans()}),
spans as (
  select row, number, kind,
    list_sum(list_transform(gaps[1:k], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0) as start,
    length(hits[k]) as size
  from found where length(part[k]) >= least),
named as (select *, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as name from spans),
grouped as (
  select row, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access,
    count(*) filter (number = 2) as n_hex,
    string_agg(name, ',' order by start, number) filter (number < 3) as base,
    string_agg(name, ',' order by start, number) as spans
  from named group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join grouped using (row)
"""

OP6 = f"""
with recursive tokens as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [list_aggregate(w, 'string_agg', ' ')]
    else list_transform(range(1, len(w) - 2), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3]) end) as s
  from tokens),
sizes as (select doc_id, cast(len(s) as bigint) as n_shingles from sets),
rows as (select doc_id, unnest(s) as shingle from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from rows a join rows b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * n >= 80 * (x.n_shingles + y.n_shingles - n)),
reach(a, b) as (
  select doc_id, doc_id from documents union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a as doc_id, min(b) as component_id from reach group by 1)
select doc_id, n_shingles, component_id, doc_id = component_id as kept from sizes join least using (doc_id)
"""



def _hex_number(text: str, digits: int) -> str:
    return " + ".join(f"(instr('0123456789abcdef', substr({text}, {k + 1}, 1)) - 1) * {16 ** (digits - 1 - k)}" for k in range(digits))


# crc32 of a word by its table of 256 remainders, which the rule of the checksum gives
CRC_TABLE = """list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, range(0, 8)),
    lambda c, k: case when c % 2 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end))"""
OP11 = f"""
with texts as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
wanted as (
  select regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
own as (select row, unnest(w) as word from texts),
other as (select unnest(w) as word from wanted),
spelled as (
  select word, lower(hex(word)) as h from (select word from own union select word from other)),
hashed as (
  select word, xor(4294967295::bigint, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(0, len(h) // 2), lambda i: {_hex_number("substr(h, 2 * i + 1, 2)", 2)})),
      lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]))) % 10000 as bucket
  from spelled, (select {CRC_TABLE} as crc)),
s as (select bucket, count(*) as n from own join hashed using (word) group by 1),
t as (select bucket, count(*) as n from other join hashed using (word) group by 1),
sizes as (select (select coalesce(sum(n), 0) from s) + 10000 as s_all, (select coalesce(sum(n), 0) from t) + 10000 as t_all),
gains as (
  select b.bucket, cast(floor(1000 * ln((cast(coalesce(t.n, 0) + 1 as double) * s_all) / (cast(coalesce(s.n, 0) + 1 as double) * t_all))) as bigint) as gain
  from (select distinct bucket from hashed) b left join s on s.bucket = b.bucket left join t on t.bucket = b.bucket, sizes),
weights as (select row, sum(gain) as weight from own join hashed using (word) join gains using (bucket) group by row),
scored as (
  select row, doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) as bigint) + cast(floor(-1000 * ln(-ln(({_hex_number("sha256('2024:' || coalesce(cast(doc_id as varchar), ''))", 8)} + 0.5::double) / 4294967296))) as bigint) as score
  from texts left join weights using (row)),
ordered as (
  select row, row_number() over (order by score desc, doc_id) as place, count(*) over () as able from scored where n_words >= 20)
select doc_id, n_words as n_features, weight, score, case when place <= able * 10 // 100 then place end as rank, n_words
from scored left join ordered using (row)
"""

ORACLES: dict[str, str] = {"op4_secret_scan": OP4, "op6_minhash_near_dups": OP6, "op11_importance_resampling": OP11}
