"""SQL for the rows of hard negatives, conversation repair and the similarity join, written for small tables."""

HARD_NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor, a.label = b.label as same, b.vec_id as id, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor, id as positive, score as positive_score from s where same
  qualify row_number() over (partition by anchor order by score desc, id) <= 5),
n as (
  select anchor, positive, row_number() over (partition by anchor, positive order by score desc, id) as rank, id, positive_score, score
  from p join s using (anchor) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor as anchor_id, positive as positive_id, rank::int as rank, id as negative_id, positive_score, score as negative_score from n where rank <= 3
"""

JACCARD = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from d),
t as (select doc_id, unnest(s) as x from g),
c as (select a.doc_id as a, b.doc_id as b, count(*) as n from t a join t b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (
  select a, b from c join g ga on ga.doc_id = a join g gb on gb.doc_id = b where 100 * n >= 90 * (len(ga.s) + len(gb.s) - n)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id, doc_id as root from g union select e.b, r.root from r join e on e.a = r.doc_id)
select g.doc_id, len(any_value(g.s))::bigint as n_shingles, min(r.root) as component_id from g join r on r.doc_id = g.doc_id group by g.doc_id
"""


def _insert(x: str, role: str) -> str:
    return f"struct_pack(c := {x}.c + 5, a := {x}.a || 'I', r := list_append({x}.r, '{role}:'))"


def _delete(x: str) -> str:
    return f"struct_pack(c := {x}.c + 2, a := {x}.a || 'D', r := {x}.r)"


def _keep(x: str, initial: str) -> str:
    row = f"struct_pack(c := {x}.c + more, a := {x}.a || 'K', r := list_append({x}.r, role || ':' || text))"
    return f"case when stays and initial = '{initial}' then {row} end"


def _rerole(x: str, role: str) -> str:
    return f"case when stays then struct_pack(c := {x}.c + 1 + more, a := {x}.a || 'R', r := list_append({x}.r, '{role}:' || text)) end"


_NONE, _FAR = "struct_pack(c := 0, a := '', r := []::varchar[])", "struct_pack(c := 1000000000, a := '', r := []::varchar[])"
_STEP = ", ".join(
    f"list_min([{', '.join(c)}]) as {q}1"
    for q, c in {
        "e": [_delete("e"), _keep("e", "")],
        "s": [_delete("s"), _keep("e", "s"), _keep("s", "")],
        "u": [_delete("u"), _keep("u", ""), *(_keep(x, "u") for x in "esa"), *(_rerole(x, "user") for x in "esa")],
        "a": [_delete("a"), _keep("a", ""), _keep("u", "a"), _rerole("u", "assistant")],
    }.items()
)
_INSERTS = "list_min([u1, " + ", ".join(_insert(f"{x}1", "user") for x in "esa") + "])"

CONVERSATIONS = rf"""
with recursive b as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint),
      lambda h, c: list_reduce(range(8), lambda x, i: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end), xor(h, c)), 4294967295::bigint), 4294967295::bigint) % 20 as code
  from conversations),
m as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role,
    case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from b, unnest(range(case code when 0 then 0 when 3 then 2 else 1 end))),
o as (
  select *, left(role, 1) as initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) as last,
    row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i
  from (select *, row_number() over (partition by conv_id, role, text order by turn nulls first) as copy from m)),
f as (
  select *, case when last = '' then 'blank' when copy > 1 then 'duplicate' when last not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as odd
  from o),
g as (
  select *, fault in ('', 'truncated') as stays, case when fault = 'truncated' then 5 else 0 end as more from f),
dp as (
  select conv_id, 0::bigint as i, {_NONE} as e, {_FAR} as s, {_insert(_NONE, "user")} as u, {_insert("(" + _insert(_NONE, "user") + ")", "assistant")} as a from (select distinct conv_id from conversations)
  union all
  select conv_id, i, e1, s1, u2, list_min([a1, {_insert("u2", "assistant")}]) from (
    select *, {_INSERTS} as u2 from (
      select dp.conv_id, g.i, {_STEP} from dp join g on g.conv_id = dp.conv_id and g.i = dp.i + 1))),
z as (
  select conv_id, list_min([e, a]) as x from dp qualify row_number() over (partition by conv_id order by i desc) = 1),
k as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (odd) as illegal
  from g group by 1)
select z.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  x.c::bigint as cost, x.a as audit, sha256(array_to_string(x.r, chr(10))) as repaired_sha256
from z left join k on k.conv_id = z.conv_id
"""
