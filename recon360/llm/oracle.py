"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from recon360.llm.lexical import TERM
from recon360.llm.queries import MIX_EXPONENT, MIX_SEED
from recon360.llm.quality_rules import RULES, Risk, level_cuts

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = f"""
with d as (select doc_id, sha256({_LOWER}) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""

OP6 = f"""
with sizes as (select source, count(*) as n from documents group by source),
weighted as (select source, n, pow(n, {MIX_EXPONENT}) as weight from sizes),
rated as (select source, weight / sum(weight) over () * sum(n) over () / n as rate from weighted),
steps as (
    select source, rate, unnest(range(greatest(0, floor(rate - 12 * sqrt(rate) - 30))::bigint,
                                      ceil(rate + 12 * sqrt(rate) + 30)::bigint + 1)) as j
    from rated
),
cdf as (
    select source, j, sum(exp(j * ln(rate) - rate - lgamma(j + 1))) over (partition by source order by j) as p from steps
),
draws as (
    select *, ('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 13))::bigint / 4503599627370496.0 as u from documents
),
counted as (
    select d.doc_id, min(c.j) as k from draws d join cdf c on d.source is not distinct from c.source and c.p > d.u
    group by d.doc_id
),
copies as (select doc_id, unnest(range(1, k + 1)) as copy_no from counted)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, copy_no, md5('{MIX_SEED}:' || d.doc_id || ':' || copy_no) as shuffle_key
from copies join documents d using (doc_id)
"""

OP11 = f"""
with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
shingled as (
    select doc_id, case when len(w) < 2 then w
                        else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
    from words
),
sets as (select any_value(s) as s, min(doc_id) as node, len(s) as n from shingled where len(s) > 0 group by list_sort(s), len(s)),
shingles as (select node, n, unnest(s) as shingle from sets),
links as (
    select a.node as x, b.node as y from shingles a join shingles b on a.shingle = b.shingle and a.node < b.node
    group by a.node, b.node, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways as (select x, y from links union all select y, x from links),
reach as (select node, node as other from sets union select r.node, l.y from reach r join both_ways l on l.x = r.other),
named as (select node, min(other) as component_id from reach group by node),
of_set as (select list_sort(s) as s, component_id from sets join named using (node))
select d.doc_id, len(d.s)::bigint as n_shingles, coalesce(o.component_id, d.doc_id) as component_id,
       coalesce(o.component_id, d.doc_id) = d.doc_id as kept
from shingled d left join of_set o on list_sort(d.s) = o.s
"""

OP12 = f"""
with d as (
    select doc_id, regexp_extract_all({_LOWER}, '{TERM}') as t from documents
),
counted as (select doc_id, t, len(t) as n from d where len(t) > 0),
size as (select count(*) as all_docs, sum(n)::bigint as all_terms from counted),
tfs as (
    select doc_id, term, count(*) as tf, 75 + (25 * any_value(n) * any_value(all_docs)) // any_value(all_terms) as m
    from (select doc_id, n, unnest(t) as term from counted), size group by doc_id, term
),
weights as (
    select term, floor(1000 * ln((2 * any_value(all_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
    from tfs, size group by term
),
asked as (
    select item_id, term, count(*) as times
    from (select item_id, unnest(regexp_extract_all({_LOWER}, '{TERM}')) as term from benchmark) group by item_id, term
),
scored as (
    select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
    from asked join weights using (term) join tfs using (term) group by item_id, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 20
"""


def _op3() -> str:
    risk = Risk()
    steps = ", ".join(
        f"({r}, {t}, {float(cuts[r])}, '{rule.name}')" for t, cuts in enumerate(level_cuts(RULES)) for r, rule in enumerate(RULES)
    )
    values = " ".join(f"when {r} then {rule.feature}" for r, rule in enumerate(RULES))
    below = ", ".join(str(r) for r, rule in enumerate(RULES) if not rule.above)
    beyond = f"coalesce(case when rule in ({below}) then v < cut else v > cut end, false)"
    p = risk.rejected
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    return rf"""
with w as materialized (
    select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t, {words} as ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
    from documents
),
positions as (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5),
windows as (select doc_id, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') as win from positions),
repeated as (select doc_id, i from windows qualify count(*) over (partition by doc_id, win) > 1),
covered as (
    select doc_id, count(distinct i + k) as n_repeat_words from repeated, (select unnest(range(0, 5)) as k) group by doc_id
),
f0 as materialized (
    select w.doc_id, stratum, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
           (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls)::bigint as n_word_lines,
           coalesce(c.n_repeat_words, 0)::bigint as n_repeat_words
    from w left join covered c using (doc_id)
),
f as materialized (
    select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed from f0
),
judged as (
    select doc_id, min(quality) as quality from labels where quality is not null group by doc_id having min(quality) in (0, 1)
),
grid(rule, step, cut, name) as (values {steps}),
judged_at as (
    select doc_id, stratum, quality, step, bool_or({beyond}) as hit
    from (select *, case rule {values} end as v from f join judged using (doc_id), grid where not base_failed)
    group by all
),
counted as (
    select stratum, step, count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and hit) as k,
           count(*) filter (quality = 0 and hit) as caught
    from judged_at group by all
),
tested as (
    select *, case when k >= n * {p} then 1.0 else list_sum(list_transform(range(0, k + 1),
        lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln({1 - p})))) end as tail
    from counted
),
cuts as (
    select stratum, step from tested where tail <= {risk.error} / (select count(distinct stratum) from f)
    qualify row_number() over (partition by stratum order by caught desc, step) = 1
),
hits as (
    select doc_id, string_agg(name, ',' order by rule) as rejected_by
    from (select f.doc_id, g.name, g.rule, g.cut, case g.rule {values} end as v
          from f join cuts c using (stratum) join grid g using (step))
    where {beyond} group by doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and rejected_by is null) as kept, coalesce(rejected_by, '') as rejected_by
from f left join hits using (doc_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": _op3(),
    "op5_exact_dedup": OP5,
    "op6_mixing": OP6,
    "op11_minmax_hash": OP11,
    "op12_lexical_search": OP12,
}
