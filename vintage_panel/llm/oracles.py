"""DuckDB SQL for the queries that SQL can express, on the same tables."""

from __future__ import annotations

WORDS = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"

MIX = rf"""
with rows as (
  select doc_id, case when source is null then 'n' else 's' || source end as k, source,
    cast(len({WORDS}) as bigint) as size
  from documents),
src as (
  select k, any_value(source) as source, cast(sum(size) as bigint) as source_size from rows group by k),
ranked as (
  select *, [3, 1, 2][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
  from src),
filling as (
  select *, row_number() over o as step, sum(source_size) over () as total,
    coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (o rows between current row and unbounded following) as rest
  from ranked window o as (order by source_size / weight, k)),
lev as (
  select *, cast(3 * total - 4 * before as bigint) as num, cast(2 * rest as bigint) as den,
    2 * source_size * 2 * rest <= weight * (3 * total - 4 * before) as capped
  from filling),
open_at as (select arg_min(num, step) as num, arg_min(den, step) as den from lev where not capped),
targets as (
  select k, source_size,
    case when capped then cast(2 * source_size as double)
      else cast(weight * (select num from open_at) as double) / (select den from open_at) end as target
  from lev),
placed as (
  select doc_id, r.k, size, source_size, target,
    cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)
      % cast(256 + ceil(source_size / 1000000) as bigint) as block
  from rows r join targets t on r.k = t.k),
blocks as (
  select k, block, any_value(source_size) as source_size, any_value(target) as target, sum(size) as block_size
  from placed group by k, block),
summed as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as passes,
    2 * sum(block_size) over (
      partition by k
      order by cast('0x' || substr(md5('mix|' || k || '|' || block), 1, 13) as bigint), block
      rows unbounded preceding) - block_size as middle
  from blocks),
taken as (
  select k, block, passes + case
    when target - passes * source_size > 0 and middle <= 2 * (target - passes * source_size)
    then 1 else 0 end as times
  from summed)
select doc_id, size, cast(source_size as bigint) as source_size, target,
  cast(size * times as bigint) as taken
from placed join taken using (k, block)
"""

EXACT = """
with norm as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, sha256(t) as text_sha256
from norm window g as (partition by t)
"""

OWN_EDGE = (
    "quantile_disc(v, 0.75) + greatest(3 * (quantile_disc(v, 0.75) - quantile_disc(v, 0.25)), any_value(slack))"
)

QUALITY = rf"""
with base as (
  select doc_id, lang, source, coalesce(text, '') as t, {WORDS} as w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from documents),
windows as (
  select doc_id, p, w[p:p + 7] as win
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as p from base)),
twice as (
  select doc_id, p from (select *, count(*) over (partition by doc_id, win) as n from windows) where n > 1),
covered as (
  select doc_id, cast(sum(least(8, coalesce(next_p - p, 8))) as bigint) as n
  from (select *, lead(p) over (partition by doc_id order by p) as next_p from twice) group by doc_id),
stats as (
  select b.doc_id, lang, source, cast(len(w) as bigint) as n_words,
    cast(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as bigint) as word_chars,
    cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words, len(lines) as n_lines,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as n_capitals
  from base b left join covered c using (doc_id)),
grid as (
  select doc_id, lang, source, n_words > 0 as used, unnest(['symbols', 'dup_lines', 'repeats', 'capitals', 'word_length']) as metric,
    unnest([60, 300, 150, 300, 4000]) as slack, unnest([100, 300, 300, 400, 12000]) as prior,
    unnest([
      case when word_chars > 0 then n_symbols * 1000 // word_chars else 0 end,
      case when n_lines > 0 then n_dup_lines * 1000 // n_lines else 0 end,
      case when n_words > 0 then n_repeat_words * 1000 // n_words else 0 end,
      case when word_chars > 0 then n_capitals * 1000 // word_chars else 0 end,
      case when n_words > 0 then least(word_chars * 1000 // n_words, 1000000) else 0 end]) as v,
    unnest([1, 2, 3, 4, 5]) as place
  from stats),
of_all as (
  select metric, least(own, (own * n + prior * 20) // (n + 20)) as edge
  from (select metric, {OWN_EDGE} as own, count(*) as n, any_value(prior) as prior from grid where used group by metric)),
of_lang as (
  select lang, o.metric, least(own, (own * n + a.edge * 20) // (n + 20)) as edge
  from (select lang, metric, {OWN_EDGE} as own, count(*) as n from grid where used group by lang, metric) o
  join of_all a on o.metric = a.metric),
edges as (
  select o.lang, source, o.metric, least(own, (own * n + a.edge * 20) // (n + 20)) as edge
  from (select lang, source, metric, {OWN_EDGE} as own, count(*) as n from grid where used group by lang, source, metric) o
  join of_lang a on o.lang is not distinct from a.lang and o.metric = a.metric),
broken as (
  select g.doc_id, arg_min(g.metric, g.place) as metric
  from grid g join edges e on g.lang is not distinct from e.lang and g.source is not distinct from e.source
    and g.metric = e.metric
  where v > edge group by g.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and metric is null as kept, case when base_failed then 'base' else metric end as rule
from (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from stats)
left join broken using (doc_id)
"""

ORACLES = {"op1_mix": MIX, "op2_exact_dedup": EXACT, "op10_quality": QUALITY}

LINES = r"""
with line as (
  select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i
  from documents),
placed as (
  select *, trim(replace(line, chr(13), ''), ' ') as bare,
    regexp_matches(line, '[^\x20\x09-\x0D]') as is_full
  from line),
full_lines as (
  select doc_id, bare, row_number() over (partition by doc_id order by i) - 1 as place from placed where is_full),
windows as (
  select doc_id, place, [bare, lead(bare, 1) over d, lead(bare, 2) over d] as w, lead(bare, 2) over d is not null as whole
  from full_lines window d as (partition by doc_id order by place)),
later as (
  select doc_id, place from windows where whole
  qualify row_number() over (partition by w order by doc_id, place) > 1),
covered as (select distinct doc_id, place + k as place from later, unnest([0, 1, 2]) u(k)),
numbered as (
  select *, sum(is_full::int) over (partition by doc_id order by i) - 1 as place from placed),
kept as (
  select n.*, n.is_full and c.place is not null as gone
  from numbered n left join covered c on n.doc_id = c.doc_id and n.place = c.place)
select doc_id, count(*) filter (is_full) as n_lines, count(*) filter (gone) as n_removed,
  case when any_value(text) is not null then sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) end as kept_sha256
from kept group by doc_id
"""

ORACLES["op4_line_dedup"] = LINES

AUDIT = rf"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {WORDS} as w from documents),
marks as (
  select doc_id, max((quality is not distinct from 1)::int) as good, max((toxic is not distinct from 1)::int) as toxic
  from labels where doc_id is not null group by doc_id),
fails as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) over (partition by t), false)] as f
  from texts left join marks using (doc_id)),
groups as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from fails group by part, f),
letters as (select unnest(range(1, 6)) as k),
orders as (
  select [a.k, b.k, c.k, d.k, e.k] as o
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps as (
  select o, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') as filter_order,
    unnest(range(1, 6)) as step from orders),
found as (
  select part, filter_order, step, o[step] as k, n, good, toxic, f[o[step]] as fails,
    list_bool_or(list_transform(o[1:step - 1], lambda x: f[x])) as gone,
    list_sum(list_transform(f, lambda x: x::int)) = 1 as alone
  from steps, groups),
counts as (
  select part, filter_order, step, k,
    sum(n) filter (not fails and not coalesce(gone, false)) as kept,
    sum(n) filter (fails and not coalesce(gone, false)) as removed,
    sum(n) filter (fails and gone) as redundant,
    sum(n) filter (fails and alone) as unique_fails,
    sum(good) filter (fails and not coalesce(gone, false)) as good_lost,
    sum(toxic) filter (fails and not coalesce(gone, false)) as toxic_lost
  from found group by all)
select part, filter_order, cast(step as int) as step,
  cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
  cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
  cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, k) as bigint) as shapley
from counts
"""

ORACLES["op11_filter_audit"] = AUDIT


def _edited(text: str, cost: str, letter: str) -> str:
    """A path, cost in nine digits and then its letters, one edit further; NULL stays NULL."""
    return f"lpad(cast(cast(left({text}, 9) as int) + {cost} as varchar), 9, '0') || substr({text}, 10) || '{letter}'"


_FROM_ANY = "least(s0, s1, s3)"  # the states that a user's turn may follow
_STAYS = "case when o.fault < 2 then {} end"
_EXTRA = "5 * o.fault"

REPAIR = rf"""
with recursive bits as (
  select list_transform(range(256), lambda c:
    list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
      case when a & 1 = 1 then xor(3988292384, a >> 1) else a >> 1 end)) as tab),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations),
dealt as (
  select conv_id, turn, role, text, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: cast(ascii(x) as bigint))),
      lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8))) % 20 as k
  from given, bits),
damaged as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
    case k when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when k = 3 then 2 else 1 end)) as copy
  from dealt where k <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare
  from damaged),
judged as (
  select *, left(role, 1) as ini, bare = '' as is_blank,
    bare <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as is_dup,
    coalesce(lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) not in ('su', 'ua', 'au'), false) as is_illegal
  from placed),
coded as (
  select *, not is_blank and not is_dup and right(bare, 1) not in ('.', '!', '?') as is_cut,
    case when is_blank or is_dup then 2 when right(bare, 1) in ('.', '!', '?') then 0 else 1 end as fault
  from judged),
convs as (
  select g.conv_id, coalesce(len(ops), 0) as n, ops, gaps, blank, dup, cut, illegal
  from (select distinct conv_id from conversations) g left join (
    select conv_id, list({{'ini': ini, 'fault': fault}} order by i) as ops,
      coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum(is_blank::int) as blank,
      sum(is_dup::int) as dup, sum(is_cut::int) as cut, sum(is_illegal::int) as illegal
    from coded group by conv_id) c on g.conv_id is not distinct from c.conv_id),
paths as (
  select conv_id, n, ops, 0 as i, {_edited("'000000000'", "0", "")} as s0, cast(null as varchar) as s1,
    {_edited("'000000000'", "5", "I")} as s2, {_edited("'000000000'", "10", "II")} as s3
  from convs
  union all
  select conv_id, n, ops, i, s0, s1, s2, least(s3, {_edited("s2", "5", "I")}) from (
    select conv_id, n, ops, i, s0, s1, least(s2, {_edited("least(s0, s1, s3)", "5", "I")}) as s2, s3 from (
      select conv_id, n, ops, i + 1 as i, {_edited("s0", "2", "D")} as s0,
        least({_edited("s1", "2", "D")}, {_STAYS.format("case when o.ini = 's' then " + _edited("s0", _EXTRA, "K") + " end")}) as s1,
        least({_edited("s2", "2", "D")}, {_STAYS.format(_edited(_FROM_ANY, "1 + " + _EXTRA, "R"))},
          {_STAYS.format("case when o.ini = 'u' then " + _edited(_FROM_ANY, _EXTRA, "K") + " end")}) as s2,
        least({_edited("s3", "2", "D")}, {_STAYS.format(_edited("s2", "1 + " + _EXTRA, "R"))},
          {_STAYS.format("case when o.ini = 'a' then " + _edited("s2", _EXTRA, "K") + " end")}) as s3
      from (select *, ops[i + 1] as o from paths where i < n)))),
best as (
  select conv_id, cast(left(least(s0, s3), 9) as bigint) as cost, substr(least(s0, s3), 10) as audit
  from paths where i = n),
letters as (
  select conv_id, unnest(range(1, length(audit) + 1)) as p, unnest(string_split(audit, '')) as l
  from best where audit <> ''),
edits as (
  select *, sum((l <> 'I')::int) over w as i, sum((l <> 'D')::int) over w as e
  from letters window w as (partition by conv_id order by p)),
told as (
  select e.conv_id, p, l, e, c.role, c.text,
    max((l = 'K' and c.ini = 's')::int) over (partition by e.conv_id) as system_first
  from edits e left join coded c on e.conv_id is not distinct from c.conv_id and e.i = c.i and l <> 'I'),
hashed as (
  select conv_id, sha256(string_agg(
    case when l = 'K' then role when (e - system_first) % 2 = 1 then 'user' else 'assistant' end
      || ':' || case when l = 'I' then '' else text end, chr(10) order by p)) as sha
  from told where l <> 'D' group by conv_id)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(dup, 0) as bigint) as duplicate, cast(coalesce(cut, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cost, audit, coalesce(sha, sha256('')) as repaired_sha256
from convs c join best b on c.conv_id is not distinct from b.conv_id
left join hashed h on c.conv_id is not distinct from h.conv_id
"""

ORACLES["op12_conversation_repair"] = REPAIR
