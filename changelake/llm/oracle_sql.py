"""DuckDB SQL of the operators' queries that SQL can express: written from the
contracts, by other means than the operators."""

#: All pairs of equal label, and everything reachable from each vector.
OP2 = """
with recursive
usable as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v
  from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select a.vec_id as x, b.vec_id as y
  from usable a join usable b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.98),
reach as (select x, y from pairs union select r.x, p.y from reach r join pairs p on r.y = p.x),
counted as (select x, count(*) as n from pairs group by x),
least_of as (select x, min(y) as least_id from reach group by x)
select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(least_id, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(least_id, e.vec_id)) as kept
from embeddings e left join counted c on e.vec_id = c.x left join least_of l on e.vec_id = l.x
"""

#: crc32 bit by bit, then the cheapest edits row by row: for each last role of
#: the output the best (cost, audit, lines) so far.
OP13 = r"""
with recursive
src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations),
keyed as (select distinct key, list_transform(string_split(key, ''), lambda c: cast(ord(c) as bigint)) as bytes from src),
crcs as (
  select key, xor(list_reduce(list_prepend(cast(4294967295 as bigint), bytes), lambda c, b: list_reduce(
      list_prepend(xor(c, b), [0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint]),
      lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)), 4294967295::bigint) % 20 as d
  from keyed),
damaged as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
         case when d = 1 then '' when d = 2 then translate(text, '.!?', '') else text end as text, copy, d
  from src join crcs using (key), (values (0), (1)) as copies(copy)
  where d <> 0 and (copy = 0 or d = 3)),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy, nth) as i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
  from (select *, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth
        from damaged)),
faults as (
  select conv_id, turn, role, text, i, left(role, 1) as initial,
         case when body = '' then 'blank' when nth > 1 then 'duplicate'
              when right(body, 1) not in ('.', '!', '?') then 'truncated' else 'none' end as fault
  from numbered),
paired as (
  select *, lag(initial) over (partition by conv_id order by i) || initial as pair from faults),
counts as (
  select conv_id, count(*) as n,
         case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from paired group by conv_id),
-- The best prefix of each last role: nothing, s, u, a. Inserts come before each row and at the end.
none as (select {'cost': 1000000000::bigint, 'audit': '', 'lines': []::varchar[]} as never),
steps as (
  select c.conv_id, 0::bigint as i, c.n,
         {'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]} as p0, never as p1, never as p2, never as p3
  from (select distinct conv_id from src) o left join counts c on o.conv_id is not distinct from c.conv_id, none
  where c.n is not null
  union all
  select conv_id, i, n,
         -- with the row: delete, keep, rerole
         least(del0, never) as p0,
         least(del1, case when keeps and initial = 's' then {'cost': q0.cost + late, 'audit': q0.audit || 'K', 'lines': list_append(q0.lines, line)} else never end) as p1,
         least(del2,
               case when keeps and initial = 'u' then {'cost': q0.cost + late, 'audit': q0.audit || 'K', 'lines': list_append(q0.lines, line)} else never end,
               case when keeps and initial = 'u' then {'cost': q1.cost + late, 'audit': q1.audit || 'K', 'lines': list_append(q1.lines, line)} else never end,
               case when keeps and initial = 'u' then {'cost': q3.cost + late, 'audit': q3.audit || 'K', 'lines': list_append(q3.lines, line)} else never end,
               case when keeps then {'cost': q0.cost + 2 + late, 'audit': q0.audit || 'R', 'lines': list_append(q0.lines, 'user:' || text)} else never end,
               case when keeps then {'cost': q1.cost + 2 + late, 'audit': q1.audit || 'R', 'lines': list_append(q1.lines, 'user:' || text)} else never end,
               case when keeps then {'cost': q3.cost + 2 + late, 'audit': q3.audit || 'R', 'lines': list_append(q3.lines, 'user:' || text)} else never end) as p2,
         least(del3,
               case when keeps and initial = 'a' then {'cost': q2.cost + late, 'audit': q2.audit || 'K', 'lines': list_append(q2.lines, line)} else never end,
               case when keeps then {'cost': q2.cost + 2 + late, 'audit': q2.audit || 'R', 'lines': list_append(q2.lines, 'assistant:' || text)} else never end) as p3
  from (
    select *, role || ':' || text as line, fault not in ('blank', 'duplicate') as keeps, (fault = 'truncated')::bigint as late,
           {'cost': q0.cost + 3, 'audit': q0.audit || 'D', 'lines': q0.lines} as del0,
           {'cost': q1.cost + 3, 'audit': q1.audit || 'D', 'lines': q1.lines} as del1,
           {'cost': q2.cost + 3, 'audit': q2.audit || 'D', 'lines': q2.lines} as del2,
           {'cost': q3.cost + 3, 'audit': q3.audit || 'D', 'lines': q3.lines} as del3
    from (
      select s.conv_id, f.i, s.n, f.role, f.text, f.initial, f.fault, never, p0 as q0, p1 as q1,
             least(p2, ins_u0, ins_u1, ins_u3) as q2,
             least(p3, {'cost': p2.cost + 2, 'audit': p2.audit || 'I', 'lines': list_append(p2.lines, 'assistant:')},
                   {'cost': ins_u0.cost + 2, 'audit': ins_u0.audit || 'I', 'lines': list_append(ins_u0.lines, 'assistant:')},
                   {'cost': ins_u1.cost + 2, 'audit': ins_u1.audit || 'I', 'lines': list_append(ins_u1.lines, 'assistant:')}) as q3
      from (select *, {'cost': p0.cost + 2, 'audit': p0.audit || 'I', 'lines': list_append(p0.lines, 'user:')} as ins_u0,
                   {'cost': p1.cost + 2, 'audit': p1.audit || 'I', 'lines': list_append(p1.lines, 'user:')} as ins_u1,
                   {'cost': p3.cost + 2, 'audit': p3.audit || 'I', 'lines': list_append(p3.lines, 'user:')} as ins_u3
            from steps) s
      join faults f on f.conv_id is not distinct from s.conv_id and f.i = s.i + 1, none))),
ends as (
  select conv_id, least(p0, p3,
         {'cost': p2.cost + 2, 'audit': p2.audit || 'I', 'lines': list_append(p2.lines, 'assistant:')},
         {'cost': p1.cost + 4, 'audit': p1.audit || 'II', 'lines': list_concat(p1.lines, ['user:', 'assistant:'])}) as best
  from steps where i = n)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from src) o
left join counts c on o.conv_id is not distinct from c.conv_id
left join ends e on o.conv_id is not distinct from e.conv_id
"""

ORACLE = {"op2_rabitq": OP2, "op13_turns": OP13}
