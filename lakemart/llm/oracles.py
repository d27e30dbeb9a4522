"""SQL for DuckDB with the results of the registered operators, where SQL can express them."""

from __future__ import annotations

import re

from lakemart.llm.license_join import BETWEEN, PHRASES, TEMPLATES, WORD, telling_words


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _places(phrase: str) -> str:
    """Where the words of a phrase stand in succession in the list ``w``."""
    parts = " and ".join(f"w[i + {k}] = {_text(p)}" for k, p in enumerate(phrase.split(), 1))
    return f"list_filter(range(len(w)), lambda i: {parts})"


def licenses(threshold: float = 0.8) -> str:
    split = lambda x: f"list_filter(string_split_regex({x}, {_text(BETWEEN + '+')}), lambda x: x <> '')"
    known = [(label, set(re.findall(WORD + "+", text.lower()))) for label, text in TEMPLATES]
    lists = [[f"[{', '.join(map(_text, sorted(x)))}]::varchar[]" for x in pair] for pair in telling_words(known, threshold)]
    values = ", ".join(f"({i}, {_text(label)}, {_text(text.lower())}, {lists[i][0]}, {lists[i][1]})" for i, (label, text) in enumerate(TEMPLATES))
    phrases = [(p, label) for p, label in sorted(PHRASES.items(), key=lambda x: x[1])]
    found = " || ".join(f"case when len({_places(p)}) > 0 then [{_text(label)}] else [] end" for p, label in phrases)
    return f"""
with docs as (select row_number() over () as r, doc_id, lower(coalesce(text, '')) as t from documents),
split as (select r, doc_id, {split('t')} as w from docs),
based as (select r, doc_id, len(w) as n_words, {' || '.join(_places(p) for p, _ in phrases)} as places, {found} as base from split),
templates as (select id, label, list_distinct({split('s')}) as s, len({split('s')}) as n, must, must_not from (values {values}) v(id, label, s, must, must_not)),
texts as (select r, id, w from split, templates where len(list_intersect(w, s)) >= ceil({threshold} * len(s) - 1e-9)),
blocks as (
  select r, id, list_distinct({split('b')}) as b
  from (select r, id, unnest(string_split(regexp_replace(t, '([.!?])[ \\t\\n\\x0B\\f\\r]', '\\1' || chr(10), 'g'), chr(10))) as b from docs join texts using (r))
  union all
  select r, id, list_distinct(w[i : i + n - 1]) as b
  from (select r, id, w, n, unnest(range(1, greatest(len(w) - n, 0) + 2)) as i from texts join templates using (id))),
met as (select r, label, len(list_intersect(b, s)) / len(s) as held from blocks join templates using (id) where len(list_intersect(b, s)) >= ceil({threshold} * len(s) - 1e-9)
  and len(list_intersect(b, must)) = len(must) and len(list_intersect(b, must_not)) = 0),
best as (select r, list(distinct label) as labels, max(held) as held from met group by r)
select doc_id, cast(n_words as bigint) as n_words, cast(len(places) as bigint) as n_base, cast(list_min(places) as bigint) as first_word,
  cast(list_max(places) as bigint) as last_word, array_to_string(list_sort(base), ',') as base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') as labels,
  case when len(places) > 0 then 1.0::double else coalesce(held, 0.0)::double end as score
from based left join best using (r)"""


ORACLES = {"op9_license_join": licenses()}
