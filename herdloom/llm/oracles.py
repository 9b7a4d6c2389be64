"""SQL for the operators that SQL can express, over the whole tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NGRAM_JOIN = f"""
with recursive cut as (select doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} as w from documents),
sets as (select doc_id, case when len(w) >= 5 then list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from cut),
items as (select doc_id, len(s) as n, unnest(s) as item from sets),
pairs as (select a.doc_id as x, b.doc_id as y from items a join items b on a.item = b.item and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached as (select doc_id as x, doc_id as y from documents union select r.x, p.y from reached r join pairs p on r.y = p.x)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id
from sets join (select x as doc_id, min(y) as component_id from reached group by x) using (doc_id)"""

DECONTAMINATION = rf"""
with cut as (select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
own as (select item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
places as (select item_id, w, least(len(w), 13) as size, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from own where len(w) > 0),
windows as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as body from places),
spots as (select doc_id, size, w, unnest(range(1, len(w) - size + 2)) as i from cut, (select distinct size from windows) where len(w) >= size),
hits as (select doc_id, i, s.size, item_id from (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as body from spots) s
  join windows using (size, body)),
marked as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + size)) as place from hits) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from cut left join marked using (doc_id) left join named using (doc_id)"""

_RULES = {
    "short": "n_words < 50",
    "symbols": "n_symbols > 0.1 * n_words",
    "lines": "n_dup_lines > 0.3 * n_lines",
    "repeats": "100 * n_repeat_words > 50 * n_words",
}

HOST_RULES = rf"""
with cut as (select doc_id, source, coalesce(text, '') as body, {WORDS.format("coalesce(text, '')")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
grams as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from cut),
often as (select doc_id, i from (select doc_id, i, array_to_string(w[i:i + 2], ' ') as gram from grams)
  qualify count(*) over (partition by doc_id, gram) > 1),
covered as (select doc_id, count(distinct place) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as place from often) group by doc_id),
counts as (select doc_id, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(body) - length(translate(body, '#*$%&|<>', '')) as bigint) as n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    len(l) as n_lines, coalesce(n_repeat_words, 0) as n_repeat_words from cut left join covered using (doc_id)),
hosts as (select source, count(*) as n, {", ".join(f"count(*) filter (where {c}) as {r}" for r, c in _RULES.items())}
  from counts where source is not null group by source),
moments as (select {", ".join(f"sum({r}) / sum(n) as {r}_m, greatest(sum(n * ({r} / n) * ({r} / n)) / sum(n) - (sum({r}) / sum(n)) ** 2, 1e-12) as {r}_v" for r in _RULES)} from hosts),
verdicts as (select source, {" or ".join(f"({r} + greatest({r}_m * (1 - {r}_m) / {r}_v - 1, 0) * {r}_m) / (n + greatest({r}_m * (1 - {r}_m) / {r}_v - 1, 0)) > 0.5" for r in _RULES)} as bad
  from hosts, moments),
judged as (select counts.*, {_RULES["short"]} or {_RULES["repeats"]} as base_failed, coalesce(bad, false) as host_failed
  from counts left join verdicts using (source))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed, not base_failed and not host_failed as kept from judged"""

#: Every phrase spelled out and counted, in 128-bit numbers.
COLLOCATIONS = r"""
with texts as (
    select coalesce(lang, 'und') as lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as words
    from texts
), totals as (
    select lang, sum(len(words))::bigint as n from pieces group by lang
), placed as (
    select lang, words, unnest(range(1, len(words) + 1)) as i from pieces
), sized as (
    select lang, words, i, unnest([1, 2, 3]) as k from placed
), phrases as (
    select lang, k, array_to_string(words[i : i + k - 1], ' ') as phrase, count(*) as a
    from sized where i + k - 1 <= len(words) group by all
), frequent as (
    select *, string_split(phrase, ' ') as words from phrases where a >= 10
), cuts as (
    select lang, phrase, k, words, a, unnest(range(1, k)) as cut from frequent where k > 1
), scored as (
    select c.lang, c.phrase, c.a, c.cut, x.a as l, y.a as r,
           (1000000::hugeint * c.a * c.a) // (x.a::hugeint * y.a) as score
    from cuts c
    join frequent x on x.lang = c.lang and x.phrase = array_to_string(c.words[1 : c.cut], ' ')
    join frequent y on y.lang = c.lang and y.phrase = array_to_string(c.words[c.cut + 1 : c.k], ' ')
), best as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inside as (
    select lang, array_to_string(words[1 : 2], ' ') as phrase, a from frequent where k = 3
    union all
    select lang, array_to_string(words[2 : 3], ' ') as phrase, a from frequent where k = 3
), free as (
    select * from best b
    where not exists (select 1 from inside i where i.lang = b.lang and i.phrase = b.phrase and 100 * i.a >= 50 * b.a)
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""
