"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

LINE_FREQUENCY = rf"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
    {_WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents),
words as (select r, generate_subscripts(w, 1) as i, unnest(w) as x from d),
wins as (
  select r, i, concat_ws(' ', x, lead(x, 1) over o, lead(x, 2) over o) as win, lead(x, 2) over o as last
  from words window o as (partition by r order by i)),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, win) as n from wins where last is not null) where n > 1),
rep as (select r, count(distinct i + k) as n_repeat_words from twice, (values (0), (1), (2)) v(k) group by r),
lines as (
  select r, doc_id, source,
    regexp_replace(trim(regexp_replace(translate(lower(unnest(ls)), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '^$', '') as line
  from d),
freq as (
  select source, line from (select distinct source, doc_id, line from lines) group by source, line having count(*) > 20),
removed as (
  select r, sum(len(string_split(l.line, ' '))) as removed_words, count(*) as removed_lines
  from lines l join freq f on l.line = f.line and l.source is not distinct from f.source group by r),
base as (
  select d.r, doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(removed_words, 0)::bigint as removed_words, coalesce(removed_lines, 0)::bigint as removed_lines
  from d left join rep on d.r = rep.r left join removed on d.r = removed.r),
failed as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (removed_words > 0
    and (n_words - removed_words < 50 or n_words - removed_words < 0.5 * n_words)) as kept,
  removed_words, removed_lines
from failed
"""

LINE_DEDUP = r"""
with d as (select row_number() over (order by doc_id) as r, doc_id, coalesce(text, '') as t from documents),
raw as (select r, generate_subscripts(string_split(t, chr(10)), 1) - 1 as k, unnest(string_split(t, chr(10))) as line from d),
lines as (
  select r, k, words, array_to_string(words, ' ') as node from (
    select r, k, list_filter(string_split_regex(lower(line), '\s+'), lambda x: x <> '') as words from raw)
  where len(words) >= 1),
nodes as (select node, any_value(words) as words, min((r, k)) as first from lines group by node),
long as (select * from nodes where len(words) >= 8),
places as (select node, words, first, unnest(range(1, len(words) + 1)) as p from long),
variants as (
  select node, first, p, array_to_string(list_concat(words[1 : p - 1], words[p + 1 :]), ' ') as v from places),
near as (
  select node from (select node, first, min(first) over (partition by v, p) as least from variants) where least < first
  union
  select a.node from variants a join long b on a.v = b.node where b.first < a.first
  union
  select b.node from variants a join long b on a.v = b.node where a.first < b.first),
gone as (
  select r, k, near.node is not null and (r, k) = first as is_near
  from lines join nodes using (node) left join near using (node)
  where near.node is not null or (r, k) <> first),
per_doc as (
  select r, count(*) as n_removed, count(*) filter (is_near) as n_near, string_agg(k::varchar, ',' order by k) as removed_lines
  from gone group by r)
select doc_id, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_near, 0)::bigint as n_near,
  coalesce(removed_lines, '') as removed_lines
from d left join per_doc on d.r = per_doc.r
"""

COLLISION_COUNTING = """
with recursive e as (
  select row_number() over () as r, vec_id, label, embedding::double[] as v from embeddings),
usable as (
  select r, vec_id, label, v from e
  where label is not null and len(v) > 0 and not list_contains(list_transform(v, lambda x: x is null or not isfinite(x)), true)
    and list_inner_product(v, v) > 0),
pairs as (
  select a.r as a, b.r as b from usable a join usable b
    on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93),
reach(a, b) as (select r, r from e union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a),
least as (select reach.a as r, min(e.vec_id) as component_id from reach join e on e.r = reach.b group by reach.a),
n as (select a as r, count(*) as n_links from pairs group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
from e left join n on e.r = n.r left join least on e.r = least.r
"""

TRIE_COLLOCATIONS = r"""
with d as (
  select row_number() over () as r, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (
  select r, lang, generate_subscripts(ps, 1) as p, unnest(ps) as piece
  from (select r, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') as ps from d)),
cut as (select r, lang, p, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces),
words as (select r, lang, p, generate_subscripts(ws, 1) as i, unnest(ws) as w1 from cut),
runs as (
  select lang, w1, lead(w1, 1) over o as w2, lead(w1, 2) over o as w3, lead(w1, 3) over o as w4
  from words window o as (partition by r, p order by i)),
f as (
  select lang, 1 as size, w1 as phrase, count(*) as f from runs group by all
  union all
  select lang, 2, w1 || ' ' || w2, count(*) from runs where w2 is not null group by all
  union all
  select lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) from runs where w3 is not null group by all
  union all
  select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) from runs where w4 is not null group by all),
frequent as (select * from f where f >= 30),
cand as (select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from frequent where size > 1),
cuts as (
  select lang, phrase, a, ws, unnest(range(1, size)) as k from cand),
scored as (
  select c.lang, c.phrase, c.a, k, l.f as l, r.f as r,
    (2000000::hugeint * c.a // (l.f + r.f))::bigint as score
  from cuts c
  join frequent l on l.lang = c.lang and l.phrase = array_to_string(ws[1 : k], ' ')
  join frequent r on r.lang = c.lang and r.phrase = array_to_string(ws[k + 1 :], ' ')),
weakest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_ as (
  select lang, a, array_to_string(ws[s : s + n - 1], ' ') as phrase
  from cand, (values (1), (2), (3)) starts(s), (values (2), (3)) lens(n)
  where n < size and s + n - 1 <= size),
longer as (select lang, phrase, max(a) as longer_a from inner_ group by all),
totals as (select lang, count(*) as n from words group by lang)
select w.lang, row_number() over (partition by w.lang order by score desc, w.a desc, w.phrase) as rank,
  w.phrase, w.a, l, r, n, score
from weakest w join totals t on t.lang = w.lang left join longer g on g.lang = w.lang and g.phrase = w.phrase
where longer_a is null or 100 * longer_a < 80 * w.a
qualify rank <= 2000
"""

GRAM_SPELLING = r"""
with recursive tab as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select coalesce(doc_id::varchar, '') as id,
    translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
  from documents),
counted as (select id, w, count(*) as n from runs group by all),
hashed as (
  select w, n, xor(list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || w, ''),
      lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [195::bigint, unicode(x)::bigint - 64] end))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
  from counted, tab),
results as (
  select case when h % 199 = 0 then left(w, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, n
  from hashed),
words as (select word, sum(n)::bigint as n from results where length(word) >= 6 group by word having sum(n) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1)) as p from words),
shapes as (select word, n, left(word, p - 1) || '*' || substr(word, p + 1) as s, left(word, p - 1) || substr(word, p + 1) as v from places),
pairs as (
  select a.word, b.word as near, b.n as near_n from shapes a join shapes b on a.s = b.s and a.word <> b.word
  union
  select a.word, b.word, b.n from shapes a join words b on a.v = b.word
  union
  select b.word, a.word, a.n from shapes a join words b on a.v = b.word),
best as (
  select word, count(*) as n_near, max(near_n) as best_n, first(near order by near_n desc, near) as near
  from pairs group by word),
judged as (
  select w.word, case when best_n >= 5 * w.n then near end as form, w.n,
    coalesce(n_near, 0)::bigint as n_near, case when best_n >= 5 * w.n then best_n end as form_n
  from words w left join best b on b.word = w.word),
chain(word, node) as (
  select word, word from judged
  union all
  select chain.word, j.form from chain join judged j on j.word = chain.node where j.form is not null)
select j.word, j.form, c.node as root, j.n, j.n_near, j.form_n
from judged j join chain c on c.word = j.word join judged e on e.word = c.node and e.form is null
"""

ORACLE_SQL = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_collision_counting": COLLISION_COUNTING,
    "op6_line_frequency": LINE_FREQUENCY,
    "op11_trie_collocations": TRIE_COLLOCATIONS,
    "op12_gram_spelling": GRAM_SPELLING,
}
