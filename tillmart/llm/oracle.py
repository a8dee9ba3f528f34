"""SQL with the same result as the queries that SQL can express, for DuckDB."""

from tillmart.llm.host_trust import _LEAST, DAMPING, LINK, ROUNDS, RULES, THRESHOLD
from tillmart.llm.quality_rules import CONFIDENCE_LOST as LOST
from tillmart.llm.quality_rules import RISK, SHORTEST
from tillmart.llm.quality_rules import RULES as QUALITY_RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
with docs as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
  from items, unnest(range(1, len(w) - least(13, len(w)) + 2)) as u(i) where len(w) > 0
),
grams as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from docs, (select distinct n from windows) sizes, unnest(range(1, len(w) - n + 2)) as u(i) where len(w) >= n
),
found as (select r, i, n, item_id from grams join windows using (n, g)),
hits as (select r, count(distinct p) as n_hit from found, unnest(range(i, i + n)) as u(p) group by r),
named as (select r, array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids, count(distinct item_id) as n_items from found group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hits using (r) left join named using (r)"""

_TURN = "order by turn nulls first, role nulls first, text nulls first"

PREFERENCES = f"""
with cut as (
  select c.conv_id, turn, role, case when turn = last and role = 'assistant' then left(text, length(text) // 2) else text end as text
  from conversations c left join (select conv_id, max(turn) as last from conversations where role = 'assistant' group by conv_id) l using (conv_id)
  where last is null or turn <= last
),
a as (select conv_id, row_number() over (partition by conv_id {_TURN}) - 1 as pos, role, text from conversations),
b as (select conv_id, row_number() over (partition by conv_id {_TURN}) - 1 as pos, role, text from cut),
sided as (
  select conv_id, pos, a.conv_id is not null and b.conv_id is not null
         and a.role is not distinct from b.role and a.text is not distinct from b.text as same
  from a full join b using (conv_id, pos)
),
prefix as (select conv_id, coalesce(min(pos) filter (where not same), max(pos) + 1) as n_prompt from sided group by conv_id),
sides as (
  select 'p' as side, a.* from a join prefix using (conv_id) where pos < n_prompt
  union all select 'a', a.* from a join prefix using (conv_id) where pos >= n_prompt
  union all select 'b', b.* from b join prefix using (conv_id) where pos >= n_prompt
),
parts as (
  select *, '<|' || coalesce(role, '') || '|>' || chr(10) as head, coalesce(text, '') || '<|end|>' || chr(10) as body from sides
),
placed as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, side, pos // 1024 order by pos) as upto from parts
),
joined as (
  select conv_id, side, pos // 1024 as piece, string_agg(head || body, '' order by pos) as text,
         string_agg((upto - length(body)) || ',' || upto, ',' order by pos) filter (where role = 'assistant') as mask
  from placed group by all
)
select conv_id as pair_id, piece, n_prompt, coalesce(max(text) filter (where side = 'p'), '') as prompt,
       coalesce(max(text) filter (where side = 'a'), '') as chosen, coalesce(max(mask) filter (where side = 'a'), '') as chosen_mask,
       coalesce(max(text) filter (where side = 'b'), '') as rejected, coalesce(max(mask) filter (where side = 'b'), '') as rejected_mask
from joined join prefix using (conv_id) group by conv_id, piece, n_prompt"""


def _rule(column: str) -> str:
    longest_first = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    value = {"rule": lambda r: r[1] + r[2], "verdict": lambda r: r[0]}[column]
    fits = [f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{value((v, h, p))}'" for v, h, p in longest_first]
    return "case " + " ".join(fits) + " end"


def _rank(kind: str, source: str, target: str) -> str:
    """Chained steps of one kind's ranks: SQL has no loop over sums."""
    steps = f"""
{kind}_seed as (select host, n / sum(n) over () as seed from (
  select host, count(*) as n from judged where host <> '' and verdict = '{'allow' if kind == 'trust' else 'block'}' group by host)),
{kind}_edge as (select {source} as src, {target} as dst, n / sum(n) over (partition by {source}) as weight from edges),
{kind}_0 as (select host, seed as rank from {kind}_seed)"""
    for i in range(ROUNDS):
        steps += f""",
{kind}_{i + 1} as (select host, sum(rank) as rank from (
  select dst as host, {DAMPING} * rank * weight as rank from {kind}_{i} join {kind}_edge on src = host
  union all
  select host, (1 - {DAMPING} + {DAMPING} * coalesce((select sum(rank) from {kind}_{i} where host not in (select src from {kind}_edge)), 0)) * seed
  from {kind}_seed) group by host)"""
    return steps


URL_TRUST = f"""
with split as (
  select page_id, html, """ + _LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')") + f""" as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
),
judged as (select *, {_rule("rule")} as rule, {_rule("verdict")} as verdict from split),
linked as (
  select host as src, {_LOWER.format("t")} as dst
  from (select host, unnest(list_distinct(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1))) as t from judged where host <> '')
),
labels as (select string_split(host, '.') as l from (select distinct host from judged where host <> '')),
above as (
  select distinct array_to_string(l[i:], '.') as low, array_to_string(l[i + 1:], '.') as high
  from labels, unnest(range(1, len(l) - 1)) as u(i) where len(l) >= 3
),
edges as (select src, dst, sum(n) as n from (
  select src, dst, 1 as n from linked where src <> dst
  union all select low, high, 1 from above union all select high, low, 1 from above) group by src, dst),
{_rank("trust", "src", "dst")},
{_rank("distrust", "dst", "src")}
select page_id, j.host, path, rule,
       coalesce(verdict, case when coalesce(d.rank, 0) > {THRESHOLD} * coalesce(t.rank, 0) + {_LEAST} then 'block' else 'allow' end) as verdict
from judged j left join trust_{ROUNDS} t on t.host = j.host left join distrust_{ROUNDS} d on d.host = j.host"""

_CUTOFFS = ", ".join(f"('{rule}', {i}, {c})" for rule, (_, _, cutoffs) in QUALITY_RULES.items() for i, c in enumerate(cutoffs))
_MEASURE = "case rule " + " ".join(f"when '{rule}' then 1000 * {n} > cutoff * {d}" for rule, (n, d, _) in QUALITY_RULES.items()) + " end"
_P = RISK / len(QUALITY_RULES)

QUALITY = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\x0D]')) as lines
  from documents
),
grams as (select r, i, array_to_string(w[i:i + 2], ' ') as g from docs, unnest(range(1, len(w) - 1)) as u(i) where len(w) >= 3),
twice as (select r, i from grams join (select r, g from grams group by r, g having count(*) > 1) using (r, g)),
covered as (select r, count(distinct p) as n from twice, unnest(range(i, i + 3)) as u(p) group by r),
measures as (
  select r, doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols, len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from docs left join covered using (r)
),
cutoffs(rule, step, cutoff) as (values {_CUTOFFS}),
good as (select * from measures where doc_id in (select doc_id from labels group by doc_id having min(quality) = 1)),
tests as (
  select stratum, rule, step, cutoff, count(*) as n, count(*) filter (where {_MEASURE}) as k from good, cutoffs group by all
),
chances as (
  select *, case when k >= n * {_P} then 1 else (
    select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({_P}) + (n - j) * ln(1 - {_P}))) from unnest(range(0, k + 1)) as u(j)
  ) end as chance
  from tests
),
passed as (
  select *, bool_and(chance <= {LOST} / ((select count(distinct stratum) from good) * {len(QUALITY_RULES)}))
              over (partition by stratum, rule order by step rows unbounded preceding) as ok
  from chances
),
chosen as (select stratum, rule, min(cutoff) as cutoff from passed where ok group by stratum, rule),
failed as (select r, rule from measures join chosen using (stratum) where {_MEASURE}),
listed as (
  select r, string_agg(rule, ',' order by list_position([{", ".join(f"'{rule}'" for rule in QUALITY_RULES)}], rule)) as failed_rules from failed group by r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {SHORTEST} or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < {SHORTEST} or 100 * n_repeat_words > 50 * n_words) and failed_rules is null as kept,
       coalesce(failed_rules, '') as failed_rules
from measures left join listed using (r)"""

TOP_K = """
with whole as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as (
  select q.r, q.vec_id as query_id, c.vec_id, c.r as other, cast(list_inner_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.r <> c.r and q.vec_id % 100 = 0 and len(q.v) = len(c.v)
)
select query_id, cast(row_number() over (partition by r order by score desc, vec_id nulls last, other) as integer) as rank, vec_id, score
from scores qualify rank <= 10"""

COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
runs as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as words from pieces),
totals as (select lang, sum(len(words)) as n from runs group by lang),
places as (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i from runs, (select unnest(range(1, 6)) as size) where len(words) >= size),
phrases as (
  select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase, count(*) as f from places group by all having count(*) >= 100
),
cuts as (
  select lang, phrase, f, size, unnest(range(1, size)) as k, string_split(phrase, ' ') as words from phrases where size > 1
),
scored as (
  select c.lang, c.phrase, c.f as a, c.k, x.f as l, y.f as r, cast(n as bigint) as n,
         cast(1000 * c.f::hugeint * n::hugeint // (x.f::hugeint * y.f::hugeint) as bigint) as score
  from cuts c join totals using (lang)
  join phrases x on x.lang = c.lang and x.phrase = array_to_string(c.words[1:k], ' ')
  join phrases y on y.lang = c.lang and y.phrase = array_to_string(c.words[k + 1:], ' ')
),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
left_over as (
  select * from lowest s where not exists (
    select 1 from phrases p where p.lang = s.lang and p.size > len(string_split(s.phrase, ' ')) and p.f >= s.a
      and contains(' ' || p.phrase || ' ', ' ' || s.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from left_over qualify rank <= 2000"""

ORACLE = {
    "op6_quality_rules": QUALITY,
    "op2_decontamination": DECONTAMINATION,
    "op4_url_trust": URL_TRUST,
    "op7_preferences": PREFERENCES,
    "op11_top_k": TOP_K,
    "op13_collocations": COLLOCATIONS,
}
