"""The results of the registered queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from lotwise.llm.settings import DOMAINS, MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS


def _level(k: int) -> str:
    """One level of the tree: water-filling of every parent's budget over its children."""
    path = ["domain", "language", "source_name"][:k + 1]
    nodes, parent = ", ".join(path), ", ".join(path[:-1]) or "1"
    names = " ".join(f"when {' and '.join(f'{c} = {v!r}' for c, v in zip(path, p, strict=True))} then {w}"
                     for p, w in MIX_WEIGHTS.items() if len(p) == k + 1)
    budget = "select min(budget) from root" if not k else (
        f"select u.budget from given{k - 1} u where " + " and ".join(f"u.{c} = n.{c}" for c in path[:-1]))
    return f"""
node{k} as (select {nodes}, case {names} else 1 end as weight, sum(tokens) * {MIX_EPOCHS} as most from supply group by all),
order{k} as (select n.*, ({budget})::hugeint as budget from node{k} n),
fill{k} as (select *, coalesce(sum(most) over (r rows between unbounded preceding and 1 preceding), 0) as filled,
    sum(weight) over (r rows between current row and unbounded following) as open_weight
    from order{k} window r as (partition by {parent} order by most::double / weight, {path[-1]})),
full{k} as (select *, most::hugeint * open_weight <= (budget - filled)::hugeint * weight as is_full from fill{k}),
rest{k} as (select *, budget - coalesce(sum(most) filter (is_full) over (partition by {parent}), 0) as remains,
    sum(weight) filter (not is_full) over (partition by {parent}) as sharers from full{k}),
part{k} as (select *, case when not is_full then (remains::hugeint * weight) // sharers::hugeint end as part,
    case when not is_full then (remains::hugeint * weight) % sharers::hugeint end as remainder from rest{k}),
given{k} as (select {nodes}, (case when is_full then most else part + case when
    row_number() over (partition by {parent} order by is_full, remainder desc, {path[-1]})
    <= remains - coalesce(sum(part) over (partition by {parent}), 0) then 1 else 0 end end)::hugeint as budget from part{k})"""


def mixing() -> str:
    domains = " ".join(f"when source in ({', '.join(repr(f'src{k}') for k in ks)}) then '{name}'" for name, ks in DOMAINS.items())
    return f"""
with rows as (select doc_id, case {domains} else 'other' end as domain, coalesce(lang, '') as language,
    coalesce(source, '') as source_name, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as tokens from documents),
supply as (select domain, language, source_name, sum(tokens) as tokens from rows group by all having sum(tokens) > 0),
root as (select least(sum(tokens) * {MIX_SHARE[0]} // {MIX_SHARE[1]}, sum(tokens) * {MIX_EPOCHS})::hugeint as budget from supply),
{_level(0)}, {_level(1)}, {_level(2)},
taken as (select r.doc_id, r.domain, r.language, r.source_name, r.tokens, s.tokens as leaf_tokens, g.budget,
    unnest(range(0, {MIX_EPOCHS})) as epoch from rows r join supply s using (domain, language, source_name)
    join given2 g using (domain, language, source_name) where r.tokens > 0),
placed as (select *, sum(tokens) over (partition by domain, language, source_name, epoch
    order by md5('{MIX_SEED}:' || epoch || ':' || coalesce(doc_id::varchar, '')), doc_id, tokens
    rows between unbounded preceding and current row) - tokens as start,
    least(leaf_tokens, budget - epoch * leaf_tokens) as part from taken)
select doc_id, domain, language, source_name, epoch::bigint as epoch, start::bigint as start, tokens::bigint as n_tokens,
    least(tokens, part - start)::bigint as n_taken
from placed where start < part"""


DECONTAMINATION = r"""
with doc_words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
patterns as (select distinct item, least(10, len(w)) as size, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') as p
    from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from item_words where len(w) > 0)),
sizes as (select distinct size from patterns),
places as (select doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') as p
    from (select doc_id, size, w, unnest(range(1, len(w) - size + 2)) as k from doc_words, sizes where len(w) >= size)),
hits as (select doc_id, k, size, item from places join patterns using (size, p)),
covered as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(k, k + size)) as place from hits) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (doc_id) left join found using (doc_id)"""


LINE_DEDUP = r"""
with rows as (select row_number() over () as r, doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
places as (select doc_id, text, unnest(range(1, len(lines) - 1)) as k, lines from rows where len(lines) >= 3),
windows as (select distinct doc_id, text, k, lines[k] || chr(10) || lines[k + 1] || chr(10) || lines[k + 2] as w from places),
later as (select doc_id, text, k from (select *, row_number() over (partition by w order by doc_id nulls first, text, k) as n from windows) where n > 1),
gone as (select distinct doc_id, text, unnest([k, k + 1, k + 2]) as k from later),
lines as (select r, doc_id, text, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as k from rows),
kept as (select r, l.doc_id, count(*) as n_lines, count(g.k) as n_removed,
    coalesce(string_agg(line, chr(10) order by l.k) filter (g.k is null), '') as kept
    from lines l left join gone g on l.doc_id is not distinct from g.doc_id and l.text = g.text and l.k = g.k group by r, l.doc_id)
select doc_id, n_lines, n_removed, length(kept)::bigint as kept_chars, md5(kept) as kept_md5 from kept"""


TOP_K = """
with whole as (select vec_id, [floor(64 * x::double)::bigint for x in embedding] as v from embeddings
    where embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
    from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20"""


_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
with rows as (select doc_id, {_LOWERED.format("coalesce(text, '')")} as t from documents),
groups as (select t, max(doc_id) as keep_id, count(*) as group_size from rows group by t)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256 from rows join groups using (t)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, byte by byte."""
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end"
    return (f"xor(4294967295::bigint, list_reduce([4294967295::bigint] || [ascii(x)::bigint for x in string_split({text}, '')], "
            f"lambda a, b: list_reduce([xor(a, b)] || [0::bigint for x in range(8)], lambda c, k: {step})))")


def _tree(name: str, levels: int) -> str:
    """Levels of the trees ``{name}0`` (tree, place, h): digests, and the siblings of each node from left to right.

    A tree of one node is complete and stays as it is.
    """
    out = []
    for k in range(levels):
        out.append(f"""
{name}_run{k} as (select *, place // 16 as up, count(*) over (partition by tree) as nodes from {name}{k}),
{name}{k + 1} as (select tree, up as place, case when min(nodes) = 1 then min(h) else sha256(string_agg(h, '' order by place)) end as h
    from {name}_run{k} group by tree, up),
{name}_side{k} as (select a.tree, a.place, a.nodes > 1 as moves, coalesce(string_agg(b.h, '' order by b.place) filter (b.place < a.place), '') as l,
    coalesce(string_agg(b.h, '' order by b.place) filter (b.place > a.place), '') as r
    from {name}_run{k} a join {name}_run{k} b on a.tree = b.tree and a.up = b.up group by a.tree, a.place, a.nodes)""")
    return ",".join(out)


def merkle_manifest(levels: int = 5, top: int = 3) -> str:
    """Up to 16 ** levels rows of a source, and 16 ** top sources."""
    def leaf(text: str) -> str:
        fields = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"
    joins = " ".join(f"left join inner_side{k} i{k} on i{k}.tree = n.tree and i{k}.place = n.place // {16 ** k}" for k in range(levels))
    joins += " join outer0 o on o.source_tree = n.tree " + " ".join(f"left join outer_side{k} o{k} on o{k}.place = o.place // {16 ** k}" for k in range(top))
    sides = [f"i{k}" for k in range(levels)] + [f"o{k}" for k in range(top)]
    proof = " || ".join(f"case when {s}.moves then {s}.l || {s}.r else '' end" for s in sides)
    folds, previous = [], "claimed"
    for k, s in enumerate(sides):
        folds.append(f"folded{k} as (select *, case when {s}.moves then sha256({s}.l || {previous} || {s}.r) else {previous} end as f{k} "
                     f"from {'path' if not k else f'folded{k - 1}'})")
        previous = f"f{k}"
    return f"""
with coded as (select doc_id, coalesce('s' || source, '') as tree, {leaf('text')} as leaf,
    case when {crc32('doc_id::varchar')} % 5 = 0 then {leaf(_LOWERED.format('text'))} else {leaf('text')} end as claimed from documents),
numbered as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place from coded),
inner0 as (select tree, place, leaf as h from numbered),{_tree('inner', levels)},
outer0 as (select '' as tree, row_number() over (order by tree) - 1 as place, h, tree as source_tree from inner{levels}),{_tree('outer', top)},
path as (select n.doc_id, n.leaf, n.claimed, o.h as subroot, (select h from outer{top}) as root, sha256({proof}) as proof_sha256,
    {', '.join(f'{s}' for s in sides)} from numbered n {joins}),
{', '.join(folds)}
select doc_id, leaf, subroot, root, proof_sha256, {previous} as folded_root, {previous} = root as verified from folded{len(sides) - 1}"""


#: States: 0 nothing written, 1 a system turn, 2 a user turn, 3 an assistant turn was written last.
REPAIR = rf"""
with recursive source as (select *, {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations),
damaged as (select coalesce('c' || conv_id, '') as conv, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
    case kind when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
    unnest(case when kind = 3 then [1, 2] else [1] end) as copy from source where kind <> 0),
bodies as (select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body, left(role, 1) as initial,
    row_number() over (partition by conv order by turn nulls first, role, sha256(text), copy) as i,
    row_number() over (partition by conv, role, text order by turn nulls first, copy) as times from damaged),
rows as (select *, body = '' as blank, body <> '' and times > 1 as repeated,
    body <> '' and times = 1 and right(body, 1) not in ('.', '!', '?') as cut,
    lag(initial) over (partition by conv order by i) || initial as pair from bodies),
counted as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (repeated) as duplicate, count(*) filter (cut) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, max(i) as n from rows group by conv),
inserts(q, r, put, paid) as (values (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 2), (1, 2, 'I', 2), (2, 3, 'I', 2),
    (3, 2, 'I', 2), (0, 3, 'II', 4), (1, 3, 'II', 4)),
turns(r, s, letter, price, initial) as (values (0, 0, 'D', 3, ''), (1, 1, 'D', 3, ''), (2, 2, 'D', 3, ''), (3, 3, 'D', 3, ''),
    (0, 2, 'R', 2, ''), (1, 2, 'R', 2, ''), (2, 3, 'R', 2, ''), (3, 2, 'R', 2, ''),
    (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a')),
moves as (select q, s, put || letter as letters, paid + price as price, letter, initial from inserts join turns using (r)),
ways(conv, i, q, best) as (
    select conv, 0::bigint, 0, {{'cost': 0::bigint, 'audit': ''}} from counted
    union all
    select w.conv, n.i, m.s, min({{'cost': w.best.cost + m.price + (n.cut and m.letter <> 'D')::int, 'audit': w.best.audit || m.letters}})
    from ways w join rows n on n.conv = w.conv and n.i = w.i + 1 join moves m on m.q = w.q
        and (m.letter = 'D' or not (n.blank or n.repeated)) and (m.letter <> 'K' or m.initial = n.initial)
    group by w.conv, n.i, m.s),
ends(q, put, paid) as (values (0, '', 0), (3, '', 0), (2, 'I', 2), (1, 'II', 4)),
least as (select conv, min({{'cost': best.cost + paid, 'audit': best.audit || put}}) as best
    from ways join counted using (conv) join ends using (q) where i = n group by conv),
letters as (select conv, p, substr(best.audit, p, 1) as letter from (select conv, best, unnest(range(1, length(best.audit) + 1)) as p from least)),
placed as (select *, sum((letter <> 'I')::int) over (partition by conv order by p) as i, sum((letter <> 'D')::int) over (partition by conv order by p) as o from letters),
written as (select p.conv, p.p, p.letter, p.o, n.role, n.text, max((p.o = 1 and p.letter = 'K' and n.initial = 's')::int) over (partition by p.conv) as headed
    from placed p left join rows n on n.conv = p.conv and n.i = p.i and p.letter <> 'I' where p.letter <> 'D'),
repaired as (select conv, string_agg(case letter when 'K' then role else case when (o - headed) % 2 = 1 then 'user' else 'assistant' end end
    || ':' || case letter when 'I' then '' else text end, chr(10) order by p) as lines from written group by conv)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.cost, 0)::bigint as cost,
    coalesce(best.audit, '') as audit, sha256(coalesce(lines, '')) as repaired_sha256
from (select distinct conv_id, coalesce('c' || conv_id, '') as conv from conversations)
    left join counted using (conv) left join least using (conv) left join repaired using (conv)"""
