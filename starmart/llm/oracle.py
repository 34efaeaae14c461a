"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from starmart.llm.secrets import BASE, MORE

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EXACT = """
select doc_id,
       max(doc_id) over same as keep_id,
       count(*) over same as group_size,
       row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1
           as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""

NEAR = f"""
with recursive
worded as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
        '[^\\x20\\x09-\\x0D]+') as w
    from documents
),
sets as (
    select doc_id, case
        when len(w) >= 4 then list_distinct(list_transform(
            range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')]
        else [] end as g
    from worded
),
flat as (select doc_id, len(g) as n, unnest(g) as s from sets),
often as (select s from flat group by s having count(*) > 1),
few as (select flat.* from flat join often using (s)),
pairs as (
    select a.doc_id as x, b.doc_id as y
    from few a join few b on a.s = b.s and a.doc_id < b.doc_id
         and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
links as (select x, y from pairs union all select y, x from pairs),
reach as (
    select doc_id as x, doc_id as y from documents
    union
    select reach.x, links.y from reach join links on reach.y = links.x
)
select sets.doc_id, cast(len(g) as bigint) as n_shingles, min(reach.y) as component_id,
       sets.doc_id = min(reach.y) as kept
from sets join reach on reach.x = sets.doc_id
group by sets.doc_id, len(g)
"""


# The checksum's table, from its polynomial.
_CRC_TABLE = """crc as (
    select list(v order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)), lambda a, b:
            case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
        from range(256) r(i))
)"""


def _crc32(text: str) -> str:
    """The unsigned checksum of a text's UTF-8 bytes, next to ``crc``."""
    byte = f"cast('0x' || hex({text})[i:i + 1] as bigint)"
    spread = f"list_transform(range(1, length(hex({text})) + 1, 2), lambda i: {byte})"
    step = "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {spread}), {step}), 4294967295)"


TRIE = f"""
with {_CRC_TABLE},
own as (
    select conv_id as c, length(coalesce(role, '')) || ':' || coalesce(role, '')
               || coalesce(text, '') as k,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as w,
           row_number() over (partition by conv_id
               order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
    from conversations where conv_id is not null
),
convs as (select c, c - c % 20 as base, {_crc32("cast(c as varchar)")} % 4 as h
          from (select distinct c from own), crc),
rebuilt as (
    select convs.c, pos, k, w from convs join own on own.c = base and pos <= h
    union all
    select convs.c, pos, k, w from convs join own on own.c = convs.c and pos > h
),
seqs as (select c, list(k order by pos) as s, list(w order by pos) as ws
         from rebuilt group by c
         union all
         select c, cast([] as varchar[]), cast([] as bigint[]) from convs
         where c not in (select c from rebuilt)),
prefixes as (
    select c, d, s[1:d] as p, case when len(s) = d then c end as ending,
           case when d = 0 then 0 else ws[d] end as w
    from (select *, unnest(range(0, len(s) + 1)) as d from seqs)
),
nodes as (
    select d, p, min(c) as c, count(*) as n, any_value(w) as w,
           sha256(coalesce(string_agg(cast(ending as varchar), ',' order by ending), '')) as ends
    from prefixes group by d, p
),
children as (select d - 1 as d, p[1:d - 1] as p, count(*) as n from nodes where d > 0
             group by all),
below as (
    select p[1:u] as p, u as d, cast(sum((n - 1) * w) as bigint) as saved,
           cast(count(*) filter (leaf) as bigint) as leaves
    from (select nodes.*, unnest(range(0, nodes.d + 1)) as u, children.n is null as leaf
          from nodes left join children on children.d = nodes.d and children.p = nodes.p)
    group by all
)
select v.c as conv_id, v.d as depth, up.c as parent_conv_id, v.n as n_convs,
       coalesce(children.n, 0) as n_children, below.leaves as n_leaves,
       below.saved as saved_tokens, v.ends as ends_sha256
from nodes v
join below on below.d = v.d and below.p = v.p
left join children on children.d = v.d and children.p = v.p
left join nodes up on up.d = v.d - 1 and up.p = v.p[1:v.d - 1]
"""

SPELLING = f"""
with recursive {_CRC_TABLE},
runs as (
    select id, translate(r, '{_UPPER}', '{_UPPER.lower()}') as r, count(*) as k
    from (select coalesce(cast(doc_id as varchar), '') as id,
                 unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as r
          from documents)
    where length(r) >= 7 group by all
),
hashed as (select r, k, {_crc32("id || ':' || r")} as h from runs, crc),
slipped as (
    select case when h % 31 = 0 then r[:h % length(r)] || r[h % length(r) + 2:] else r end as w, k
    from hashed
),
words as (select w, cast(sum(k) as bigint) as n from slipped where length(w) >= 7
          group by w having sum(k) >= 2),
dels as (select w, i, w[:i] || w[i + 2:] as d
         from (select w, unnest(range(0, length(w))) as i from words)),
near as (
    select a.w as x, b.w as y from dels a join dels b on a.i = b.i and a.d = b.d and a.w <> b.w
    union
    select dels.w, words.w from dels join words on dels.d = words.w
    union
    select words.w, dels.w from dels join words on dels.d = words.w
),
best as (
    select x, count(*) as n_near, min((-n, y)) as b from near join words on y = w group by x
),
formed as (
    select w, n, coalesce(n_near, 0) as n_near, case when -b[1] >= 10 * n then b[2] end as form,
           case when -b[1] >= 10 * n then -b[1] end as form_n
    from words left join best on x = w
),
ways as (
    select w, w as root, form as next from formed
    union all
    select ways.w, ways.next, formed.form from ways join formed on formed.w = ways.next
)
select w as word, form, root, n, n_near, form_n
from formed join (select w, root from ways where next is null) using (w)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    """Each rule's spans from the pieces between its matches, then all of them in order."""
    lists = []
    for order, r in enumerate(BASE + MORE):
        p = _quoted(r.pattern)
        lists.append(f"""
    list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: {{
        's': cast(coalesce(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x))), 0)
             + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i - 1], lambda x: length(x))), 0) as bigint),
        'o': {order},
        'n': length(regexp_extract_all(t, {p})[i]),
        'k': '{r.kind}',
        'v': length(regexp_extract_all(t, {p}, {r.value_group})[i])
    }}), lambda m: m.v >= {r.min_chars}) as {r.kind}""")
    name = "lambda m: m.k || ':' || m.s || ':' || (m.s + m.n)"

    def joined(rules) -> str:
        parts = ", ".join(r.kind for r in rules)
        return f"array_to_string(list_transform(list_sort(flatten([{parts}])), {name}), ',')"

    counts = ", ".join(f"cast(len({r.kind}) as bigint) as n_{r.kind}" for r in BASE)
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
found as (select doc_id, {', '.join(lists)} from d)
select doc_id, {counts}, sha256({joined(BASE)}) as base_sha256, {joined(BASE + MORE)} as spans
from found
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secret_scan": _secrets(),
        "op4_minhash_near_dedup": NEAR,
        "op10_exact_dedup": EXACT,
        "op12_prefix_trie": TRIE,
        "op13_spelling_groups": SPELLING,
    }
