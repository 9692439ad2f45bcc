"""Queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from geoflume.llm.brown_lm import op3_brown_lm
from geoflume.llm.crf_quality import op5_crf_quality
from geoflume.llm.decontaminate import op1_decontaminate
from geoflume.llm.embedding_graph import op7_embedding_graph
from geoflume.llm.html_extract import op10_html_extract
from geoflume.llm.language_id import op13_language_id
from geoflume.llm.lexical_search import op12_lexical_search
from geoflume.llm.ngram_join import op2_ngram_join
from geoflume.llm.packing import op4_packing
from geoflume.llm.pii import op9_pii
from geoflume.llm.suffix_dedup import op6_suffix_dedup
from geoflume.llm.turn_repair import op11_turn_repair
from geoflume.llm.warc import op8_warc

QUERIES = {
    f.__name__: f
    for f in (op1_decontaminate, op2_ngram_join, op3_brown_lm, op4_packing, op5_crf_quality, op6_suffix_dedup, op7_embedding_graph, op8_warc, op9_pii, op10_html_extract, op11_turn_repair, op12_lexical_search, op13_language_id)
}

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_CRC = "xor(list_reduce(flatten(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0])), lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384), 4294967295::bigint), 4294967295)"


def _edit(state: str, audit: str, cost: str, lines: str) -> str:
    """The struct after an edit: cost, audit and lines grow; null where the state can't be reached."""
    return f"case when {state} is not null then {{'c': ({state}.c + {cost})::int, 'a': {state}.a || '{audit}', 'b': {state}.b || {lines}}} end"


_EDITS = {f"del_p{k}": _edit(f"p{k}", "D", "2", "[]::varchar[]") for k in range(4)} | {f"keep_p{k}": _edit(f"p{k}", "K", "e", "[role || ':' || text]") for k in range(4)}
_EDITS |= {f"{role}_p{k}": _edit(f"p{k}", "R", "1 + e", f"['{role}:' || text]") for k in range(4) for role in ("user", "assistant")}
_EDITS |= {f"ins_s{k}_{x}": _edit(f"s{k}", "I" * len(x), str(5 * len(x)), "[" + ", ".join({"u": "'user:'", "a": "'assistant:'"}[y] for y in x) + "]") for k in range(4) for x in ("u", "a", "ua")}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": r"""with recursive w as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    s as (select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end as x
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from w where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
    l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 90 * (na.n + nb.n - c)),
    r(doc_id, o) as (select doc_id, doc_id from documents union select r.doc_id, l.b from r join l on l.a = r.o),
    e as (select a.doc_id, min(b.doc_id) as class_id from p join n na on na.doc_id = a join n nb on nb.doc_id = b and nb.n = na.n and c = na.n, lateral (select p.a as doc_id) a, lateral (select p.b as doc_id) b group by 1)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.o) as component_id, least(d.doc_id, coalesce(any_value(e.class_id), d.doc_id)) as class_id
    from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id left join e on e.doc_id = d.doc_id group by d.doc_id, n.n""",
    "op8_warc": """with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
    m as (select payload_bytes, payload_digest, max(page_id) as last from p where payload_bytes >= 1000 group by 1, 2)
    select page_id, payload_bytes, payload_digest, case when last <> page_id then 'revisit' else 'response' end as record_type, case when last <> page_id then last end as refers_to, true as intact
    from p left join m using (payload_bytes, payload_digest)""",
    "op12_lexical_search": f"""with t as (select doc_id, {_TERMS} as w from documents),
    st as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from t),
    i as (select item_id, term, count(*) as q from (select item_id, unnest({_TERMS}) as term from benchmark) group by all),
    d as (select doc_id, len(w) as n, unnest(w) as term from t),
    tf as (select doc_id, n, term, count(*) as tf from d where term in (select term from i) group by all),
    df as (select term, count(*) as df from tf group by term),
    sc as (select item_id, doc_id, sum(q * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::double))::bigint * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score from tf join df using (term) join i using (term), st group by item_id, doc_id)
    select item_id, cast(rank as integer) as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from sc where score > 0) where rank <= 20""",
    "op11_turn_repair": r"""with recursive x as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, crc32_of as f from (select *, {crc} % 20 as crc32_of from conversations) where crc32_of <> 0),
    y as (select conv_id, turn, case f when 4 then 'user' else role end as role, case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case f when 3 then 2 else 1 end)) as copy from x),
    z as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final, left(role, 1) as q from y),
    f as (select *, final = '' as blank, final <> '' and nth > 1 as dup, final <> '' and nth = 1 and final not in ('.', '!', '?') as trunc, lag(q) over (partition by conv_id order by i) as before from z),
    r(conv_id, i, s0, s1, s2, s3) as (
        select distinct conv_id, 0::bigint, {{'c': 0, 'a': '', 'b': []::varchar[]}}, null::struct(c int, a varchar, b varchar[]), null::struct(c int, a varchar, b varchar[]), null::struct(c int, a varchar, b varchar[]) from conversations
        union all select * from (
            with p as (select r.conv_id, f.i, f.role, f.text, f.q, f.blank or f.dup as gone, case when f.trunc then 5 else 0 end as e, s0 as p0, s1 as p1,
                list_min([s2, {ins_s0_u}, {ins_s1_u}, {ins_s3_u}]) as p2, list_min([s3, {ins_s2_a}, {ins_s0_ua}, {ins_s1_ua}]) as p3 from r join f on f.conv_id is not distinct from r.conv_id and f.i = r.i + 1)
            select conv_id, i, {del_p0}, list_min([{del_p1}, case when not gone and q = 's' then {keep_p0} end]),
                list_min([{del_p2}, case when not gone and q = 'u' then {keep_p0} end, case when not gone and q = 'u' then {keep_p1} end, case when not gone and q = 'u' then {keep_p3} end, case when not gone then {user_p0} end, case when not gone then {user_p1} end, case when not gone then {user_p3} end]),
                list_min([{del_p3}, case when not gone and q = 'a' then {keep_p2} end, case when not gone then {assistant_p2} end]) from p)),
    last as (select conv_id, list_min([s0, s3, {ins_s2_a}, {ins_s1_ua}]) as w from r where (conv_id, i) in (select conv_id, max(i) from r group by 1)),
    n as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (dup) as duplicate, count(*) filter (trunc) as truncated, count(*) filter (before is not null and before || q not in ('su', 'ua', 'au')) as illegal from f group by 1)
    select last.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, w.c::bigint as cost, w.a as audit, sha256(array_to_string(w.b, chr(10))) as repaired_sha256 from last left join n using (conv_id)""".format(crc=_CRC, **_EDITS),
}
