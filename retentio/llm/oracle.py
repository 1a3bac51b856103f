"""DuckDB SQL of the corpus operators that SQL can express."""

from __future__ import annotations

from retentio.llm import cover_codes, poisson_mix

_UNIT = "('0x' || substr(md5({}), 1, 13))::BIGINT / 4503599627370496.0"

# Escaping adds a backslash before each bar that follows "<" and backslashes; the
# template adds "<|im_start|>", a line break and "<|im_end|>" with a line break to a turn.
_CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as v(t, r)),
numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
           lag(role, 1, '^') over (partition by conv_id order by turn nulls first, role, text) as before
    from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::BIGINT as loss_chars,
       sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
       sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
           + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT as formatted_chars,
       bool_and((before, role) in (('^', 'system'), ('^', 'user'), ('system', 'user'), ('user', 'assistant'),
                                   ('assistant', 'user')))
           and max_by(role, k) = 'assistant' as valid
from numbered group by conv_id
"""

# Every word covered by a window that also starts in a smaller doc_id goes.
_PASSAGES = r"""
with texts as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents),
places as (
    select r, doc_id, words, unnest(range(1, len(words) - 48)) as i from texts
    where len(words) >= 50 and doc_id is not null),
windows as (select r, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as code from places),
firsts as (select code, min(doc_id) as low from windows group by code),
gone as (
    select distinct r, unnest(range(i, i + 50)) as i
    from windows join firsts using (code) where low < doc_id),
words as (select r, unnest(words) as word, generate_subscripts(words, 1) as i from texts where len(words) > 0),
kept as (
    select w.r, count(g.i) as n_removed, string_agg(word, ' ' order by w.i) filter (g.i is null) as kept
    from words w left join gone g on w.r = g.r and w.i = g.i group by w.r)
select doc_id, len(words)::BIGINT as n_words, coalesce(n_removed, 0)::BIGINT as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (r)
"""


def _cover_codes() -> str:
    """Lloyd rounds, one pair of steps each; a vector's part is a list of integers."""
    parts, entries = cover_codes.PARTS, cover_codes.ENTRIES
    distance = "list_sum([(p.v[i] - b.v[i]) * (p.v[i] - b.v[i]) for i in range(1, len(p.v) + 1)])::BIGINT"
    steps = [f"""
with usable as (
    select row_number() over (order by vec_id, embedding) as r, vec_id, label,
           [floor({cover_codes.SCALE} * x::DOUBLE)::BIGINT for x in embedding] as v
    from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pieces as materialized (
    select r, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] as v
    from usable, range({parts}) as t(part)),
book0 as materialized (select part, r - 1 as entry, v from pieces where r <= {entries})"""]
    for k in range(cover_codes.ROUNDS):
        steps.append(f"""
near{k} as materialized (
    select p.r, p.part, min({distance} * {entries} + b.entry) % {entries} as entry
    from pieces p join book{k} b using (part) group by p.r, p.part),
sums{k} as (
    select part, entry, list(floor_mean order by i) as v from (
        select n.part, n.entry, i,
               ((sum(p.v[i]) - ((sum(p.v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT as floor_mean
        from near{k} n join pieces p using (r, part), unnest(range(1, len(p.v) + 1)) as u(i)
        group by n.part, n.entry, i)
    group by part, entry),
book{k + 1} as materialized (
    select b.part, b.entry, coalesce(s.v, b.v) as v from book{k} b left join sums{k} s using (part, entry))""")
    last = cover_codes.ROUNDS
    steps.append(f"""
final as (
    select p.r, p.part, min({distance} * {entries} + b.entry) as best
    from pieces p join book{last} b using (part) group by p.r, p.part),
coded as (
    select r, string_agg(printf('%02x', best % {entries}), '' order by part) as code,
           sum(best // {entries})::BIGINT as error
    from final group by r),
digest as (
    select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from book{last})
select vec_id, code, error, (sum(error) over (partition by label))::BIGINT as label_error, codebooks_sha256
from usable join coded using (r), digest
""")
    return ",".join(steps)


_FILL_MIDDLE = r"""
with texts as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) as h
    from documents),
drawn as (
    select *, len(units) as n, ('0x' || h[1:8])::BIGINT as h1, ('0x' || h[9:16])::BIGINT as h2,
           ('0x' || h[17:24])::BIGINT as h3, ('0x' || h[25:32])::BIGINT as h4
    from texts),
formed as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                     or h3 % 100 >= 100 then 'plain'
                when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from drawn),
cut as (
    select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
           array_to_string(units[b + 1:], '') as suffix
    from formed)
select doc_id, n::BIGINT as n, form,
       case when form <> 'plain' then length(prefix) end::BIGINT as prefix_chars,
       case when form <> 'plain' then length(middle) end::BIGINT as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""

SQL = {
    "op11_phrase_automata": _PASSAGES,
    "op12_cover_codes": _cover_codes(),
    "op13_fill_middle": _FILL_MIDDLE,
    "op2_chat_fsm": _CHAT,
    "op3_poisson_mix": f"""
with recursive counts as (
    select source, count(*) as n, pow(count(*)::DOUBLE, {poisson_mix.ALPHA}) as weight from documents group by source),
rates as (
    select source, weight / (select sum(weight) from counts) * (select sum(n)::DOUBLE from counts) / n as rate
    from counts),
cdf as (
    select source, rate, 0 as j, -rate as logp, exp(-rate) as p from rates
    union all
    select source, rate, j + 1, logp + ln(rate) - ln((j + 1)::DOUBLE),
           p + exp(logp + ln(rate) - ln((j + 1)::DOUBLE))
    from cdf where j < ceil(rate + 12 * sqrt(rate) + 40)),
drawn as (
    select d.*, {_UNIT.format(f"'{poisson_mix.SEED}:' || coalesce(doc_id::VARCHAR, '')")} as u from documents d),
counted as (
    select d.doc_id, d.text, d.lang, d.source, d.n_chars,
           (select count(*) from cdf c where c.source is not distinct from d.source and c.p <= d.u) as k
    from drawn d),
copies as (
    select * exclude (k), unnest(range(1, k + 1))::INTEGER as copy_no from counted where k > 0)
select *, {_UNIT.format(f"'{poisson_mix.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy_no::VARCHAR")} as mix_key
from copies
""",
}
