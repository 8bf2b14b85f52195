"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidewater.llm.quality import CONFIDENCE, LANGS, RISK, RULES, STEPS

_ALNUM = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

DECONTAMINATION = f"""
with d as (select doc_id, {_ALNUM} as w from documents),
b as (select item_id, {_ALNUM} as w from benchmark),
iw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win from
  (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0)),
ns as (select distinct n from iw),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win from
  (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, ns where len(w) >= n)),
hits as (select doc_id, i, dw.n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from
  (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (doc_id) left join found using (doc_id)
"""

_RULE_ROWS = " union all ".join(
    f"select *, {k} as place, '{name}' as rule, cast(least({STEPS}, ceil(({value}) / cast({top} as double) * {STEPS})) as int) as step from m"
    for k, (name, (value, top)) in enumerate(RULES.items())
)
_TESTS, _RISK = (len(LANGS) + 1) * len(RULES), RISK / len(RULES)

QUALITY = rf"""
with t as (select doc_id, coalesce(text, '') as text,
    case when lang in ({", ".join(f"'{x}'" for x in LANGS)}) then lang else 'other' end as stratum,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
g as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from
  (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t where len(w) > 2))),
r as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest(range(i, i + 3)) as p from g where n > 1) group by 1),
m0 as (select t.doc_id, stratum, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(l) as bigint) as n_lines,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from t left join r using (doc_id)),
m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m0),
s as ({_RULE_ROWS}),
good as (select stratum, rule, step from s where not base_failed and doc_id in (select doc_id from labels where quality = 1)),
k as (select stratum, rule, c.cutoff, count(*) as n, count(*) filter (where step > c.cutoff) as k
  from good, (select unnest(range(0, {STEPS})) as cutoff) c group by 1, 2, 3),
p as (select stratum, rule, cutoff, (select sum(exp(lgamma(n + 1) - (case when j = 0 then 0 else lgamma(j + 1) end)
      - (case when n = j then 0 else lgamma(n - j + 1) end) + j * ln({_RISK}) + (n - j) * ln(1 - {_RISK})))
    from (select unnest(range(0, k.k + 1)) as j)) as tail from k where k <= n * {_RISK}),
cut as (select stratum, rule, min(cutoff) as cutoff from p where tail <= {(1 - CONFIDENCE) / _TESTS!r} group by 1, 2),
bad as (select doc_id, string_agg(s.rule, ',' order by place) as rejected_by
  from s join cut on s.stratum = cut.stratum and s.rule = cut.rule and s.step > cut.cutoff group by 1)
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rejected_by is null as kept, coalesce(rejected_by, '') as rejected_by
from m left join bad using (doc_id)
"""

ORACLES = {"op4_quality": QUALITY, "op7_decontamination": DECONTAMINATION}
