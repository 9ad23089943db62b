"""DuckDB SQL for the queries that SQL can express; each works by definition, not by the operator's method."""

from __future__ import annotations

from . import urls


def _crc_table() -> list[int]:
    """The 256 steps of CRC-32 by its polynomial."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def _u(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5({key} || '/{salt}'), 1, 13))::bigint)"


def _rendezvous(key: str, shards: int) -> str:
    tries = ", ".join(
        f"{{'cost': -ln(({_u(key, str(s))} + 0.5::double) / 4503599627370496::double), 'shard': {s}}}"
        for s in range(shards)
    )
    return f"list_min([{tries}]).shard"


def op3() -> str:
    table = ", ".join(map(str, _crc_table()))
    key = "coalesce(cast(doc_id as varchar), 'null')"
    return f"""
    with bytes as (
      select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size,
             list_transform(range(octet_length(encode(coalesce(text, '')))),
               lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::bigint) as b
      from documents),
    placed as (
      select doc_id, cast(size as bigint) as size,
             xor(list_reduce(list_prepend(4294967295::bigint, b),
               lambda c, x: xor(c >> 8, [{table}][cast(xor(c, x) & 255 as integer) + 1])),
               4294967295::bigint) as text_crc32,
             {_rendezvous(key, 8)} as shard, {_rendezvous(key, 9)} as grown_shard,
             {_u(key, 'cell')} % 1024 as cell
      from bytes)
    select doc_id, size, text_crc32, 'key' as law, shard,
           row_number() over (partition by shard order by cell, doc_id, size, text_crc32) - 1 as slot,
           grown_shard
    from placed"""


def op4() -> str:
    return """
    with recursive good as (
      select vec_id, label, cast(embedding as double[]) as v from embeddings
      where label is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as (
      select a.vec_id as x, b.vec_id as y
      from good a join good b on a.label = b.label and a.vec_id <> b.vec_id
        and list_cosine_similarity(a.v, b.v) >= 0.93),
    reach as (
      select vec_id, vec_id as seen from embeddings
      union
      select reach.vec_id, links.y from reach join links on links.x = reach.seen),
    least as (select vec_id, min(seen) as component_id from reach group by vec_id)
    select vec_id, (select count(*) from links where x = vec_id) as n_links, component_id,
           vec_id = component_id as kept
    from least"""


def op10() -> str:
    return """
    with recursive words as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x20\\x09-\\x0D]+') as w
      from documents),
    sets as materialized (
      select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
               else list_distinct(list_transform(range(1, len(w) - 2),
                 lambda i: array_to_string(w[i : i + 3], ' '))) end as s
      from words),
    sizes as materialized (select doc_id, len(s) as n from sets),
    every as materialized (select doc_id, unnest(s) as g from sets),
    each as materialized (
      select doc_id, g from every where g in (select g from every group by g having count(*) > 1)),
    shared as (
      select a.doc_id as x, b.doc_id as y, count(*) as common
      from each a join each b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
    links as materialized (
      select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
      where 100 * common >= 80 * (p.n + q.n - common)),
    reach as (
      select doc_id, doc_id as seen from documents
      union
      select reach.doc_id, links.y from reach join links on links.x = reach.seen)
    select doc_id, any_value(n) as n_shingles, min(seen) as component_id, doc_id = min(seen) as kept
    from reach join sizes using (doc_id) group by doc_id"""


def op9() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    return f"""
    with parts as (
      select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest
      from pages),
    hosts as (
      select page_id, coalesce(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '') as host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
      from parts),
    fits as (
      select page_id, host, path, h || p as rule, v
      from hosts left join (values {rules}) as r(h, p, v)
        on (host = h or host like '%.' || h) and starts_with(path, p))
    select page_id, host, path, rule, coalesce(v, 'allow') as verdict
    from fits
    qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1"""


def _crc32(text: str) -> str:
    table = ", ".join(map(str, _crc_table()))
    data = f"encode({text})"
    steps = f"list_transform(range(octet_length({data})), lambda i: ('0x' || substr(hex({data}), 2 * i + 1, 2))::bigint)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::bigint, {steps}), lambda c, x: xor(c >> 8, "
        f"[{table}][cast(xor(c, x) & 255 as integer) + 1])), 4294967295::bigint)"
    )


def op11() -> str:
    """Row by row from the left: of each conversation the cheapest edits that end in each role."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"
    return f"""
    with recursive struck as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32(key)} % 20 as kind
      from conversations),
    damaged as (
      select conv_id, turn, case kind when 4 then 'user' else role end as role,
             case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
             unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
      from struck),
    placed as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
             trim(text, {white}) as body,
             case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as letter
      from damaged),
    marked as (
      select *, case when body = '' then 'blank'
                     when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                     when right(body, 1) not in ('.', '!', '?') then 'truncated' else 'fine' end as fault,
             lag(letter) over (partition by conv_id order by i) || letter as pair
      from placed),
    moves(p, q) as (values ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
    letters as (select unnest(['s', 'u', 'a', 'x']) as letter),
    edits as (
      select p, letter, p as q, 'D' as edit, 4 as cost from (select unnest(['-', 's', 'u', 'a']) as p), letters
      union all select p, q, q, 'K', 0 from moves
      union all select p, letter, q, 'R', 3 from moves, letters where q <> 's'),
    inserts(p, q, cost, audit, lines) as (values
      ('-', '-', 0, '', []::varchar[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
      ('-', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']),
      ('u', 'a', 3, 'I', ['assistant:']), ('-', 'a', 6, 'II', ['user:', 'assistant:']),
      ('s', 'a', 6, 'II', ['user:', 'assistant:'])),
    convs as (select c.conv_id, count(i) as n from (select distinct conv_id from conversations) c
              left join marked m on m.conv_id is not distinct from c.conv_id group by c.conv_id),
    steps as (
      select conv_id, 0::bigint as i, q, {{'cost': cost, 'audit': audit, 'lines': lines}} as best
      from convs, inserts where p = '-'
      union all
      select s.conv_id, s.i + 1, c.q, min({{
               'cost': s.best.cost + e.cost + c.cost + case when e.edit <> 'D' and r.fault = 'truncated' then 3 else 0 end,
               'audit': s.best.audit || e.edit || c.audit,
               'lines': s.best.lines || case e.edit when 'D' then []::varchar[] else
                 [case when e.edit = 'K' then r.role when e.q = 'u' then 'user' else 'assistant' end || ':' || r.text] end
                 || c.lines}})
      from steps s
      join marked r on r.conv_id is not distinct from s.conv_id and r.i = s.i + 1
      join edits e on e.p = s.q and e.letter = r.letter and (e.edit = 'D' or r.fault in ('fine', 'truncated'))
      join inserts c on c.p = e.q
      group by s.conv_id, s.i, c.q),
    done as (
      select s.conv_id, min(best) as best from steps s join convs c
        on s.conv_id is not distinct from c.conv_id and s.i = c.n
      where q in ('-', 'a') group by s.conv_id),
    seen as (
      select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
             count(*) filter (where fault = 'blank') as blank,
             count(*) filter (where fault = 'duplicate') as duplicate,
             count(*) filter (where fault = 'truncated') as truncated,
             count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
      from marked group by conv_id)
    select d.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank,
           coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
           coalesce(illegal, 0) as illegal, cast(best.cost as bigint) as cost, best.audit as audit,
           sha256(array_to_string(best.lines, chr(10))) as repaired_sha256
    from done d left join seen s on s.conv_id is not distinct from d.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_sharding": op3(),
        "op4_embedding_dedup": op4(),
        "op9_url_filters": op9(),
        "op10_minhash_forest": op10(),
        "op11_dialogue_repair": op11(),
    }
