"""DuckDB texts of the training-data queries that SQL can express."""

# CRC-32 of a decimal number, a byte at a time and eight shifts a byte.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
        lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)))"""

OP13_SQL = f"""
with turns as (
    select conv_id c, coalesce(role, '') r, coalesce(text, '') x,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p
    from conversations where conv_id is not null),
convs as (select c, {_CRC32} % 4 h, c - c % 20 b from (select distinct c from turns)),
rebuilt as (
    select v.c, t.p place, r, x from convs v join turns t on t.c = v.b and t.p <= v.h
    union all
    select v.c, 10 + t.p, r, x from convs v join turns t on t.c = v.c and t.p > v.h),
paths as (
    select c, x, row_number() over w d, string_agg(sha256(sha256(r) || x), '') over w path
    from rebuilt window w as (partition by c order by place rows unbounded preceding)
    union all
    select c, '', 0, '' from convs),
nodes as (
    select d, path, min(c) conv_id, count(*) n, (count(*) - 1) * len(regexp_extract_all(any_value(x), '[^\\x20\\x09-\\x0D]+')) s
    from paths group by d, path),
ends as (
    select path, string_agg(c::varchar, ',' order by c) ids
    from (select c, max(d) d, arg_max(path, d) path from paths group by c) group by path),
kids as (
    select left(path, len(path) - 64) path, count(*) n from nodes where d > 0 group by 1),
below as (
    select a.path, sum(b.s) s, sum((k.n is null)::bigint) leaves
    from nodes a join nodes b on starts_with(b.path, a.path) left join kids k on k.path = b.path group by a.path)
select n.conv_id::bigint conv_id, n.d::bigint depth, u.conv_id::bigint parent_conv_id, n.n::bigint n_convs,
       coalesce(k.n, 0)::bigint n_children, w.leaves::bigint n_leaves, w.s::bigint saved_tokens,
       sha256(coalesce(e.ids, '')) ends_sha256
from nodes n join below w on w.path = n.path left join kids k on k.path = n.path left join ends e on e.path = n.path
     left join nodes u on u.d = n.d - 1 and n.d > 0 and u.path = left(n.path, len(n.path) - 64)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
with docs as (
    select row_number() over () row, doc_id, {_TERMS} terms from documents),
lengths as (select row, doc_id, len(terms)::bigint n from docs where len(terms) > 0),
totals as (select count(*) nd, sum(n)::bigint nt from lengths),
asked as (
    select distinct item_id, text, unnest({_TERMS}) term from benchmark),
postings as (
    select row, term, count(*) tf from (select row, unnest(terms) term from docs)
    where term in (select term from asked) group by row, term),
weights as (
    select term, floor(1000 * ln((2 * any_value(nd) + 2)::double / (2 * count(*) + 1)::double))::bigint w
    from postings, totals group by term),
scores as (
    select a.item_id, a.text, l.doc_id, l.row,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // nt)))))::bigint score
    from asked a join postings p using (term) join weights using (term) join lengths l on l.row = p.row, totals
    group by a.item_id, a.text, l.doc_id, l.row),
ranked as (
    select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last) rank from scores where score > 0)
select item_id, rank::int rank, doc_id, score from ranked where rank <= 50
"""

# Sets of three-word runs, pairs by shared runs, components by all that is reachable.
OP3_SQL = r"""
with recursive docs as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x20\x09-\x0D]+'), []) w from documents),
runs as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))
        end items from docs),
sets as (
    select md5(array_to_string(items, chr(10))) k, min(doc_id) id, any_value(items) items from runs where len(items) > 0 group by 1),
postings as (select k, len(items) n, unnest(items) item from sets),
links as (
    select a.k a, b.k b from postings a join postings b on a.item = b.item and a.k <> b.k
    group by a.k, b.k having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach as (
    select k, k other from sets union select r.k, l.b from reach r join links l on l.a = r.other),
components as (select r.k, min(s.id) component from reach r join sets s on s.k = r.other group by r.k)
select doc_id, len(items)::bigint n_shingles, coalesce(component, doc_id) component_id
from runs left join components on len(items) > 0 and k = md5(array_to_string(items, chr(10)))
"""

OP9_SQL = """
with recursive vectors as (
    select row_number() over () row, vec_id::bigint vec_id, embedding::double[] v from embeddings),
usable as materialized (
    select row, list_filter(v, lambda x: x is not null and isfinite(x)) v from vectors where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
    select a.row a, b.row b from usable a join usable b on a.row <> b.row and len(a.v) = len(b.v)
    where case when len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) end >= 0.95),
reach as (
    select row, row other from vectors union select r.row, l.b from reach r join links l on l.a = r.other),
components as (
    select r.row, min(v.vec_id) component from reach r join vectors v on v.row = r.other group by r.row),
counts as (select a row, count(*) n from links group by a)
select vec_id, coalesce(n, 0)::bigint n_links, coalesce(component, vec_id) component_id,
       coalesce(vec_id = component, true) kept
from vectors join components using (row) left join counts using (row)
"""
