"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_url_rules"] = r"""
with rules(rule_host, rule_path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
         ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), read as (
  select row_number() over () as line, page_id,
         case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), cut as (
  select line, page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw_host from read
), split as (
  select line, page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
  from cut
), ranked as (
  select split.*, rule_host || rule_path as rule, verdict,
         row_number() over (partition by line
           order by length(rule_host || rule_path) desc nulls last, length(rule_host) desc) as nth
  from split left join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from ranked where nth = 1
"""

ORACLES["op5_quality_rules"] = r"""
with read as (
  select row_number() over () as line, doc_id, lang, source, coalesce(text, '') as body from documents
), worded as (
  select *, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
         list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from read
), grams as (
  select line, unnest(range(1, len(words) - 1)) as pos,
         unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) as gram
  from worded where len(words) >= 3
), again as (
  select line, pos from grams
  qualify count(*) over (partition by line, gram) > 1
), covered as (
  select line, count(distinct place) as n_repeat_words
  from (select line, pos + unnest([0, 1, 2]) as place from again) group by line
), counted as (
  select w.line, doc_id, lang, source, len(words) as n_words,
         length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from worded w left join covered c on w.line = c.line
), measured as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         coalesce(100 * word_chars // nullif(n_words, 0), 0) as word_length,
         coalesce(1000 * n_symbols // nullif(n_words, 0), 0) as symbol_rate,
         coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) as dup_line_rate,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) as repeat_rate
  from counted
), flat as (
  unpivot (select lang, source, word_length, symbol_rate, dup_line_rate, repeat_rate
           from measured where not base_failed)
  on word_length, symbol_rate, dup_line_rate, repeat_rate into name metric value value
), bucketed as (
  select lang, source, metric,
         (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) as bucket
  from flat
), every as (
  select metric, bucket, (texts * 100000 // sum(texts) over (partition by metric))::bigint as prior
  from (select metric, bucket, count(*) as texts from bucketed group by all)
), lang_sizes as (
  select lang, metric, count(*) as size from bucketed group by all
), lang_counts as (
  select lang, metric, bucket, count(*) as texts from bucketed group by all
), lang_shares as (
  select s.lang, s.metric, e.bucket,
         ((coalesce(texts, 0) * 100000 + 30 * prior) // (size + 30))::bigint as prior
  from lang_sizes s join every e using (metric)
  left join lang_counts c on s.lang is not distinct from c.lang and s.metric = c.metric and e.bucket = c.bucket
), groups as (
  select distinct lang, source, metric from bucketed
), own as (
  select lang, source, metric, bucket, count(*) as texts from bucketed group by all
), weights as (
  select g.lang, g.source, g.metric, l.bucket, coalesce(texts, 0) * 100000 + 30 * prior as weight
  from groups g join lang_shares l on g.lang is not distinct from l.lang and g.metric = l.metric
  left join own o on g.lang is not distinct from o.lang and g.source is not distinct from o.source
    and g.metric = o.metric and l.bucket = o.bucket
), ranked as (
  select *, sum(weight) over (partition by lang, source, metric order by bucket) as upto,
         sum(weight) over (partition by lang, source, metric) as total
  from weights
), quantiles as (
  select lang, source, metric, min(bucket) filter (100 * upto >= 25 * total) as q25,
         min(bucket) filter (100 * upto >= 50 * total) as q50, min(bucket) filter (100 * upto >= 75 * total) as q75,
         min(bucket) filter (100 * upto >= 90 * total) as q90, min(bucket) filter (100 * upto >= 99 * total) as q99
  from ranked group by all
), ends as (
  select lang, source, metric, case metric when 'word_length' then q75 when 'symbol_rate' then q90 else q99 end as upper,
         case metric when 'word_length' then q25 else q50 end as lower,
         case metric when 'word_length' then 6 else 1 end as reach
  from quantiles
), fences as (
  select lang, source, metric,
         upper + reach * (upper - lower) + (1::bigint << greatest(length(bin(upper)) - 6, 0)) as high,
         lower - reach * (upper - lower) as low
  from ends
), bounds as (
  select lang, source,
         max(high) filter (metric = 'word_length') as h1, max(low) filter (metric = 'word_length') as l1,
         max(high) filter (metric = 'symbol_rate') as h2,
         max(high) filter (metric = 'dup_line_rate') as h3,
         max(high) filter (metric = 'repeat_rate') as h4
  from fences group by all
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(word_length between l1 and h1 and symbol_rate <= h2
                                    and dup_line_rate <= h3 and repeat_rate <= h4, false) as kept
from measured m left join bounds b
  on m.lang is not distinct from b.lang and m.source is not distinct from b.source
"""

ORACLES["op8_line_dedup"] = r"""
with lines as (
  select doc_id, generate_subscripts(string_split(text, chr(10)), 1) as line,
         unnest(string_split(text, chr(10))) as body
  from documents
), worded as (
  select doc_id, line, body,
         list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from lines
), counted as (
  select *, len(words) >= 5 as judged, len(words) >= 1 as worded,
         row_number() over (partition by words order by doc_id, line) as nth from worded
), firsts as (
  select words, len(words) as n, doc_id, line, row_number() over (order by doc_id, line) as pos
  from counted where judged and nth = 1
), variants as (
  select words, n, pos, unnest(range(1, n + 1)) as place,
         unnest(list_transform(range(1, n + 1), lambda i: words[1:i - 1] || words[i + 1:n])) as rest
  from firsts
), replaced as (
  select words from variants qualify pos > min(pos) over (partition by rest, place, n)
), shorter as (
  select f.words, f.pos, v.pos as other, v.words as longer from firsts f join variants v on f.words = v.rest
), near as (
  select words from replaced
  union select words from shorter where other < pos
  union select longer from shorter where pos < other
), verdicts as (
  select c.*, worded and nth > 1 as exact, judged and nth = 1 and near.words is not null as close
  from counted c left join near on c.words = near.words
)
select d.doc_id, count(v.line) as n_lines, count(*) filter (exact) as n_exact,
       count(*) filter (close) as n_near,
       case when count(*) filter (exact or close) = 0 then any_value(d.text)
            else coalesce(string_agg(body, chr(10) order by line) filter (not (exact or close)), '') end as text
from documents d left join verdicts v on d.doc_id = v.doc_id group by d.doc_id
"""

ORACLES["op11_edit_lattice"] = r"""
with recursive crc_table as (
  select list(v order by i) as crc from (
    select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as v
    from range(256) numbers(i))
), keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations
), drawn as (
  select k.*, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ord(substr(key, i, 1))::bigint),
                              lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as draw
  from keyed k, crc_table
), turns as (
  select conv_id, turn, case when draw = 4 then 'user' else role end as role,
         case draw when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when draw = 3 then 2 else 1 end)) as copy
  from drawn where draw <> 0
), judged as (
  select *, substr(role, 1, 1) as initial,
         row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as pos,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
         not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
         not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as cut_off
  from turns
), numbered as (
  select conv_id, turn, role, text, initial, pos, blank, not blank and again as duplicate,
         not blank and not again and cut_off as truncated,
         coalesce(lag(initial) over (partition by conv_id order by pos) || initial not in ('su', 'ua', 'au'), false) as illegal
  from judged
), counts as (
  select conv_id, max(pos) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
         count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal
  from numbered group by conv_id
), kept(state, initial, after_it) as (
  values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserted(state, n, before_it, added) as (
  values (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
         (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
         (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']),
         (2, 2, 2, ['assistant:', 'user:']), (3, 2, 3, ['user:', 'assistant:'])
), edits as (
  select n.conv_id, pos, state, 'D' as letter, 2 as cost, state as after_it, []::varchar[] as line
  from numbered n, range(4) states(state)
  union all
  select n.conv_id, pos, k.state, 'K', case when truncated then 5 else 0 end, k.after_it, [role || ':' || text]
  from numbered n join kept k on n.initial = k.initial where not blank and not duplicate
  union all
  select n.conv_id, pos, k.state, 'R', case when truncated then 6 else 1 end, k.after_it,
         [case when k.after_it = 2 then 'user:' else 'assistant:' end || text]
  from numbered n, kept k where k.initial <> 's' and not blank and not duplicate
), walk as (
  select conv_id, 0::bigint as pos, 0 as state, row(0, '', []::varchar[]) as way from counts
  union all
  select w.conv_id, w.pos + 1, e.after_it,
         min(row((w.way)[1] + 5 * i.n + e.cost, (w.way)[2] || repeat('I', i.n) || e.letter, (w.way)[3] || i.added || e.line))
  from walk w join inserted i on i.state = w.state
  join edits e on e.conv_id is not distinct from w.conv_id and e.pos = w.pos + 1 and e.state = i.before_it
  group by 1, 2, 3
), best as (
  select w.conv_id, min(row((way)[1] + 5 * n, (way)[2] || repeat('I', n), (way)[3] || added)) as way
  from walk w join counts c on c.conv_id is not distinct from w.conv_id and w.pos = c.rows
  join inserted i on i.state = w.state and i.before_it in (0, 3)
  group by 1
), originals as (
  select distinct conv_id from conversations
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce((way)[1], 0)::bigint as cost, coalesce((way)[2], '') as audit,
       sha256(coalesce(array_to_string((way)[3], chr(10)), '')) as repaired_sha256
from originals o
left join counts c on o.conv_id is not distinct from c.conv_id
left join best b on o.conv_id is not distinct from b.conv_id
"""

ORACLES["op12_shared_lists"] = """
with sound as (
  select row_number() over () as line, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as parts
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.line, a.vec_id as anchor_id, b.line as other, b.vec_id as other_id, a.label = b.label as same,
         list_inner_product(a.parts, b.parts)::bigint as score
  from sound a join sound b on a.vec_id % 50 = 0 and a.line <> b.line
), positives as (
  select line, anchor_id, other, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by line order by score desc, other_id, other) <= 5
), hard as (
  select p.anchor_id, p.positive_id, s.other_id as negative_id, positive_score, s.score as negative_score,
         row_number() over (partition by p.line, p.other order by s.score desc, s.other_id, s.other) as rank
  from positives p join scored s on p.line = s.line and not s.same
    and 100 * s.score between 50 * positive_score and 95 * positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from hard where rank <= 3
"""

ORACLES["op4_bottom_k_near_dedup"] = r"""
with recursive worded as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w <> '') as words
  from documents
), shingles as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
  from worded where words is not null
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), sets as (
  select doc_id, n, md5(string_agg(shingle, chr(10) order by shingle)) as digest
  from shingles join sizes using (doc_id) group by doc_id, n
), firsts as (
  select digest, any_value(n) as n, min(doc_id) as first from sets group by digest
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from shingles a join shingles b using (shingle)
  where a.doc_id < b.doc_id and a.doc_id in (select first from firsts) and b.doc_id in (select first from firsts)
  group by a.doc_id, b.doc_id
), links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * shared >= 85 * (x.n + y.n - shared)
), sides as (
  select a, b from links union all select b, a from links
), reach(node, other) as (
  select first, first from firsts
  union
  select node, b from reach join sides on other = a
), components as (
  select node, min(other) as component_id from reach group by node
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id,
       d.doc_id = coalesce(component_id, d.doc_id) as kept
from documents d left join sets s on d.doc_id = s.doc_id
left join firsts f on s.digest = f.digest left join components c on f.first = c.node
"""
