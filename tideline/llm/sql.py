"""DuckDB twins of the registered queries, where SQL can express them."""

from __future__ import annotations

from tideline.llm.pii import CONTEXT_CHARS, KINDS, REPORTED

# The plain forms of the patterns; their engine matches in linear time without look-behinds.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": KINDS[4].pattern,
    "ssn": KINDS[5].pattern,
}
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: "
    f"case when i % 2 = 1 then substr({_DIGITS}, -i, 1)::int "
    f"when substr({_DIGITS}, -i, 1)::int > 4 then substr({_DIGITS}, -i, 1)::int * 2 - 9 "
    f"else substr({_DIGITS}, -i, 1)::int * 2 end)) % 10 = 0"
)
_IBAN = "substr(replace(hit, ' ', ''), 5) || substr(replace(hit, ' ', ''), 1, 4)"
_MOD97 = (
    f"list_reduce(list_concat([0::hugeint], list_transform(string_split(regexp_replace({_IBAN}, '(.)', '\\1,', 'g'), ','), lambda c: "
    "case when c = '' then -1 when c <= '9' then c::int else ord(c) - 55 end::hugeint)), "
    "lambda a, v: case when v < 0 then a when v > 9 then (a * 100 + v) % 97 else (a * 10 + v) % 97 end) = 1"
)
_PASSES = {
    "email": "true",
    "ip": "len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(try_cast(p as hugeint), 999) > 255)) = 0",
    "card": f"length({_DIGITS}) between 13 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 9 and 15",
    "iban": f"length(replace(hit, ' ', '')) between 15 and 34 and {_MOD97}",
    "ssn": "not regexp_matches(hit, '^(?:000|666|9)|-00-|-0000$')",
}


def _pii() -> str:
    parts = []
    for number, kind in enumerate(KINDS):
        score = f"{kind.start_score + kind.confirmed} + case when regexp_matches(around, '{kind.context}') then {kind.near} else 0 end"
        keep = _PASSES[kind.name] + ("" if kind.base else f" and {score} >= {REPORTED}")
        parts.append(
            f"""
select row, {number} as k, '{kind.name}' as kind, start, start + length(hit) as stop
from (
  select row, unnest(hits) as hit,
    unnest(list_transform(range(1, len(hits) + 1), lambda i:
      list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0)))::bigint as start,
    unnest(list_transform(range(1, len(hits) + 1), lambda i:
      lower(right(gaps[i], {CONTEXT_CHARS}) || ' ' || left(gaps[i + 1], {CONTEXT_CHARS})))) as around
  from (
    select row, regexp_extract_all(text, '{_PLAIN[kind.name]}') as hits,
      string_split_regex(text, '{_PLAIN[kind.name]}') as gaps
    from texts where regexp_matches(text, '{_PLAIN[kind.name]}')
  )
) where {keep}"""
        )
    base = sum(k.base for k in KINDS)
    counts = ", ".join(f"count(*) filter (where k = {i})::bigint as n_{k.name}" for i, k in enumerate(KINDS) if k.base)
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' order by k, start)"
    return f"""
with texts as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
spans as ({" union all ".join(parts)}),
per_row as (
  select row, {counts}, sha256(coalesce({joined} filter (where k < {base}), '')) as base_sha256, {joined} as spans
  from spans group by row
)
select doc_id, {", ".join(f"coalesce(n_{k.name}, 0) as n_{k.name}" for k in KINDS if k.base)},
  coalesce(base_sha256, sha256('')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_row using (row)"""


ORACLE: dict[str, str] = {"op1_pii": _pii()}
