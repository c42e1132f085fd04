"""SQL that states the results of queries independently: all pairs for the search, the best way to each state for the repair."""

from __future__ import annotations

TOPK = """
with whole as (
    select vec_id, row_number() over () as r,
           list_transform(embedding, lambda x: floor(1024 * x::double)) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
), scored as (
    select q.vec_id as query_id, q.r, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from whole q join whole c on q.r <> c.r
    where q.vec_id % 100 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by r order by score desc, vec_id) as rank from scored) t
where rank <= 10
"""

REPAIR = """
with recursive codes as (
    -- The table of the checksum by its rule: eight steps of the polynomial for each byte.
    select list(c order by i) as t
    from (select i, list_reduce(range(8), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, i) as c
          from range(256) b(i)) x
), keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
    from conversations
), summed as (
    select conv_id, turn, role, text,
           xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: ascii(c)::bigint),
                           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) % 20 as kind
    from keyed, codes
), hurt as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text
    from summed, range(2) c(i)
    where kind <> 0 and (i = 0 or kind = 3)
), placed as (
    select *, left(role, 1) as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
           row_number() over (partition by conv_id order by turn nulls first, role, text) as i
    from hurt
), judged as (
    select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
           lag(initial) over (partition by conv_id order by i) as before
    from placed
), faults as (
    select *, case when body = '' then 'blank' when again then 'duplicate'
                   when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
    from judged
), counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal,
           count(*) as n
    from faults group by conv_id
), inserts(state, after, cost, letters, turns) as (
    values ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
           ('', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'),
           ('a', 'u', 3, 'I', chr(10) || 'user:'), ('u', 'a', 3, 'I', chr(10) || 'assistant:'),
           ('', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edits(state, letter, after, cost) as (
    values ('', 'D', '', 4), ('s', 'D', 's', 4), ('u', 'D', 'u', 4), ('a', 'D', 'a', 4),
           ('', 'K', 's', 0), ('', 'K', 'u', 0), ('s', 'K', 'u', 0), ('u', 'K', 'a', 0), ('a', 'K', 'u', 0),
           ('', 'R', 'u', 3), ('s', 'R', 'u', 3), ('u', 'R', 'a', 3), ('a', 'R', 'u', 3)
), steps as (
    -- The best way to each state before row i: least cost, then least letters.
    select conv_id, 1::bigint as i, '' as state, {'cost': 0, 'letters': '', 'turns': ''} as best from counts
    union all
    select s.conv_id, s.i + 1, e.after,
           min({'cost': s.best.cost + j.cost + e.cost + case when e.letter <> 'D' and f.fault = 'truncated' then 3 else 0 end,
                'letters': s.best.letters || j.letters || e.letter,
                'turns': s.best.turns || j.turns || case e.letter when 'D' then '' when 'K' then chr(10) || f.role || ':' || f.text
                         else chr(10) || case e.after when 'u' then 'user:' else 'assistant:' end || f.text end})
    from steps s
    join faults f on f.conv_id is not distinct from s.conv_id and f.i = s.i
    join inserts j on j.state = s.state
    join edits e on e.state = j.after
    where e.letter = 'D' or (f.fault not in ('blank', 'duplicate') and (e.letter = 'R' or f.initial = e.after))
    group by s.conv_id, s.i, e.after
), ended as (
    select s.conv_id, min({'cost': s.best.cost + j.cost, 'letters': s.best.letters || j.letters, 'turns': s.best.turns || j.turns}) as best
    from steps s
    join counts c on c.conv_id is not distinct from s.conv_id and s.i = c.n + 1
    join inserts j on j.state = s.state
    where j.after in ('', 'a')
    group by s.conv_id
)
select k.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank,
       coalesce(c.duplicate, 0)::bigint as duplicate, coalesce(c.truncated, 0)::bigint as truncated,
       coalesce(c.illegal, 0)::bigint as illegal, coalesce(e.best.cost, 0)::bigint as cost,
       coalesce(e.best.letters, '') as audit, sha256(coalesce(substr(e.best.turns, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) k
left join counts c on c.conv_id is not distinct from k.conv_id
left join ended e on e.conv_id is not distinct from k.conv_id
"""

ORACLE_SQL: dict[str, str] = {"op12_topk_search": TOPK, "op13_repair": REPAIR}
