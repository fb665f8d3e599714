"""Expected results as SQL on the same tables."""

from __future__ import annotations

from orderloom.llm.pii import DISCLOSED, KINDS, REACH, SHORTEST_TERM, SUPPORT
from orderloom.llm.sharding import SHARDS, SLOTS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

EXACT_DEDUP = f"""
with keyed as (select doc_id, sha256({LOWERED}) as text_sha256 from documents),
grouped as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from keyed group by 1)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from keyed join grouped using (text_sha256)
"""


def _number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


# `claims` is a turn at a time: the shard whose turn it is, the slots taken so far.
SHARDING = f"""
with recursive shards as (
    select s::int as shard, {_number("format('shard-{:03d}', s) || '/offset'")} % {SLOTS} as first,
           {_number("format('shard-{:03d}', s) || '/stride'")} % {SLOTS - 1} + 1 as stride
    from range({SHARDS}) as r(s)
), orders as (
    select shard, list((first + j * stride) % {SLOTS} order by j) as slots
    from shards, range({SLOTS}) as r(j) group by shard
), claims as (
    select -1::bigint as turn, null::bigint as slot, [false for x in range({SLOTS})] as taken
    union all
    select turn + 1, pick, list_concat(taken[:pick], [true], taken[pick + 2:])
    from (
        select turn, taken, list_filter(slots, lambda s: not taken[s + 1])[1] as pick
        from claims join orders on shard = (turn + 1) % {SHARDS}
        where turn + 1 < {SLOTS}
    )
), placed as (
    select doc_id, {_number("coalesce(doc_id::varchar, '')")} % {SLOTS} as slot from documents
)
select doc_id, slot, (turn % {SHARDS})::int as shard
from placed join claims using (slot)
"""

WORDS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
with doc as (select doc_id, {WORDS} as w from documents),
item as (select item_id, {WORDS} as w from benchmark),
item_window as (
    select distinct item_id, least(13, len(w)) as n, array_to_string(w[s + 1:s + least(13, len(w))], ' ') as gram
    from (select item_id, w, unnest(range(0, len(w) - least(13, len(w)) + 1)) as s from item where len(w) > 0)
),
doc_window as (
    select doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') as gram
    from (
        select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as s
        from doc, (select distinct n from item_window) where len(w) >= n
    )
),
hit as (select doc_id, s, n, item_id from doc_window join item_window using (n, gram)),
hit_words as (
    select doc_id, count(distinct word) as n_hit
    from (select doc_id, unnest(range(s, s + n)) as word from hit) group by 1
),
hit_items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item_id::varchar as item from hit) group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

# Base 32 of the 40 hex digits of a SHA-1: each five digits make four characters.
BASE32 = """array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(sha, 5 * (j // 4) + 1, 5))::int >> (15 - 5 * (j % 4))) & 31) + 1, 1)
    for j in range(32)], '')"""

WARC = f"""
with keyed as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(encode(coalesce(html, ''))) as sha,
           max(page_id) over (partition by coalesce(html, '')) as original
    from pages
)
select page_id, payload_bytes, {BASE32} as payload_digest,
       case when page_id is not distinct from original then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from original then original end as refers_to
from keyed
"""

SUBSTRINGS = """
with doc as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
),
win as (
    select doc_id, s, sha256(array_to_string(w[s + 1:s + 35], ' ')) as gram
    from (select doc_id, w, unnest(range(0, len(w) - 34)) as s from doc where len(w) >= 35)
),
repeated as (select gram from win group by 1 having count(*) > 1),
gone as (
    select distinct doc_id, unnest(range(s, s + 35)) as i from win semi join repeated using (gram)
),
word as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as i from doc),
kept as (
    select doc_id, count(*) as n_kept, string_agg(word, ' ' order by i) as kept
    from word anti join gone using (doc_id, i) group by 1
)
select doc_id, len(w)::bigint as n_words, len(w) - coalesce(n_kept, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id)
"""

# --- personal data: matches and their places, then the terms that disclose an entity

_WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"


def _matches(pattern: str, what: str = "text") -> str:
    """Columns value and start (in code points) of the matches in a text, one row each."""
    return f"""hits[k] as value,
        (list_sum([length(x) for x in pieces[1:k]]) + coalesce(list_sum([length(x) for x in hits[1:k - 1]]), 0))::bigint
        as start
        from (select *, string_split_regex({what}, '{pattern}') as pieces, regexp_extract_all({what}, '{pattern}') as hits
              from doc), unnest(range(1, len(hits) + 1)) as u(k)"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum([
        (case when i % 2 = 1 then d when d > 4 then 2 * d - 9 else 2 * d end)
        for d, i in [substr(reverse({_DIGITS}), j + 1, 1)::int for j in range(length({_DIGITS}))]]) % 10 = 0"""
_FOUND = " union all ".join(
    f"select doc_id, {rank} as rank, '{kind}' as kind, {_matches(pattern.replace('(', '(?:') if kind != 'phone' else pattern)}"
    for rank, (kind, (pattern, *_)) in enumerate(KINDS.items())
)


def _lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{UPPER.lower()}')"


PERSONAL = f"""
with doc as (select doc_id, coalesce(text, '') as text from documents),
found as ({_FOUND}),
base as (
    select *, start + length(value) as stop, kind || ':' || {_lower("value")} as entity from found
    where case kind
        when 'ip' then len([p for p in string_split(value, '.') if p::double > 255]) = 0
        when 'card' then length({_DIGITS}) between 12 and 19 and {_LUHN}
        when 'phone' then length({_DIGITS}) between 9 and 15
        else true end
),
sides as (
    select entity, text, start, substr(text, greatest(start - {REACH - 1}, 1), least(start, {REACH})) as before,
           substr(text, stop + 1, {REACH}) as after
    from base join doc using (doc_id)
),
near as (
    select distinct entity, text, unnest(regexp_extract_all({_lower("before || ' ' || after")}, '{_WORD}')) as term
    from (
        select entity, text,
               case when start > {REACH} then regexp_replace(before, '^{_WORD}', '') else before end as before,
               case when length(after) = {REACH} then regexp_replace(after, '{_WORD}$', '') else after end as after
        from sides
    )
),
n_e as (select entity, count(distinct text) as n_e from base join doc using (doc_id) group by 1),
n_te as (select entity, term, count(*) as n_te from near where length(term) >= {SHORTEST_TERM} group by 1, 2),
n_t as (
    select term, count(*) as n_t
    from (select distinct text, unnest(regexp_extract_all({_lower("text")}, '{_WORD}')) as term from doc)
    where term in (select term from n_te where n_te >= {SUPPORT}) group by 1
),
disclosing as (
    select entity, term from n_te join n_e using (entity) join n_t using (term),
           (select count(distinct text)::double as n from doc)
    where n_te >= {SUPPORT} and n_e >= {SUPPORT} and n > n_e
      and ln(n * n_te / (n_t * n_e)) / ln(n / n_e) >= {DISCLOSED}
),
given_away as (select distinct doc_id, term from base join disclosing using (entity)),
words as (select doc_id, {_matches(_WORD).replace("from doc)", "from doc where doc_id in (select doc_id from given_away))")}),
terms as (
    select doc_id, {len(KINDS)} as rank, 'term' as kind, start, start + length(value) as stop
    from words w semi join given_away g on w.doc_id = g.doc_id and {_lower("w.value")} = g.term
),
spans as (
    select doc_id, rank, kind, start, stop from base
    union all
    select * from terms t anti join base b on t.doc_id = b.doc_id and t.start < b.stop and b.start < t.stop
),
shown as (
    select doc_id, string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (rank < {len(KINDS)}) as base
    from spans group by 1
),
counted as (
    select doc_id, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in KINDS)} from base group by 1
)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in KINDS)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from doc left join shown using (doc_id) left join counted using (doc_id)
"""

# --- near duplicates: all pairs of texts that share a shingle

NEAR = f"""
with recursive texts as (
    select coalesce(text, '') as text, min(doc_id) as node, count(*) as copies from documents group by 1
),
words as (select node, regexp_extract_all({LOWERED}, '{_WORD}') as w from texts),
bags as (
    select node, shingle, count(*) as weight
    from (select node, unnest([array_to_string(w[i + 1:i + least(5, len(w))], ' ')
                               for i in range(len(w) - least(5, len(w)) + 1)]) as shingle
          from words where len(w) > 0)
    group by 1, 2
),
sizes as (select node, sum(weight) as size from bags group by 1),
shared as (
    select a.node as a, b.node as b, sum(least(a.weight, b.weight)) as n
    from bags a join bags b on a.shingle = b.shingle and a.node < b.node group by 1, 2
),
links as (
    select a, b from shared join sizes x on x.node = a join sizes y on y.node = b
    where n / (x.size + y.size - n) >= 0.8
),
reached as (
    select node, node as other from texts
    union
    select node, case when other = a then b else a end from reached join links on other in (a, b)
),
classes as (select node, min(other) as class_id from reached group by 1),
sized as (select class_id, sum(copies)::bigint as class_size from classes join texts using (node) group by 1)
select d.doc_id, class_id, class_size, d.doc_id = class_id as kept
from documents d join texts t on coalesce(d.text, '') = t.text
join classes using (node) join sized using (class_id)
"""

# --- ranked search: every document that shares a term with an item

_TERMS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED = f"""
with doc as (select doc_id, {_TERMS} as w from documents),
total as (select count(*) as documents, sum(len(w))::bigint as terms from doc where len(w) > 0),
held as (
    select doc_id, term, n, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from doc) group by all
),
weights as (
    select term, floor(1000 * ln((2 * any_value(documents) + 2)::double / (2 * count(*) + 1)))::bigint as weight
    from held, total group by 1
),
asked as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
scored as (
    select item_id, doc_id,
           sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // terms))))::bigint as score
    from asked join weights using (term) join held using (term), total group by 1, 2
),
placed as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scored where score > 0
)
select * from placed where rank <= 50
"""

# --- a Merkle manifest, level by level; six levels are enough for 16 million rows a source


def _crc32(text: str) -> str:
    """Of an ASCII text, bit by bit."""
    codes = f"[ascii(substr({text}, (i + 1)::int, 1))::bigint for i in range(length({text}))]"
    bits = "lambda d, j: case when d & 1 = 1 then xor(d >> 1, 3988292384) else d >> 1 end"
    each = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bits})"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), {each}), 4294967295)"


def _part(column: str) -> str:
    text = f"{column}::varchar"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_part, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, levels: int, tree: str) -> str:
    """Tables {name}0 (tree, place, digest), {name}1, ...; and {name}_step: a node's place, its siblings before and
    after it, by level."""
    ctes = []
    for k in range(levels):
        ctes.append(f"""{name}{k + 1} as (
    select {tree}, place // 16 as place, case when max(n) = 1 then any_value(digest)
           else sha256(string_agg(digest, '' order by place)) end as digest
    from (select *, count(*) over (partition by {tree}) as n from {name}{k}) group by {tree}, place // 16
), {name}_step{k} as (
    select a.{tree} as {tree}, a.place as place,
           coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as before,
           coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as after,
           any_value(n) = 1 as done
    from {name}{k} a join (select *, count(*) over (partition by {tree}) as n from {name}{k}) b
      on a.{tree} = b.{tree} and a.place // 16 = b.place // 16
    group by a.{tree}, a.place, a.digest
)""")
    return ", ".join(ctes)


_TREE_LEVELS, _TOP_LEVELS = 6, 2


def _folded(digest: str, steps: list[str]) -> tuple[list[str], str]:
    """Columns f1, f2, ...: the node after each step; nested selects would repeat long texts."""
    out, last = [], digest
    for k, step in enumerate(steps):
        out.append(f"case when {step}.done then {last} else sha256({step}.before || {last} || {step}.after) end as f{k}")
        last = f"f{k}"
    return out, last


_STEPS = [f"s{k}" for k in range(_TREE_LEVELS)] + [f"t{k}" for k in range(_TOP_LEVELS)]
_FOLDS, _LAST_FOLD = _folded("shown", _STEPS)
_STEP_JOINS = " ".join(
    [f"join row_step{k} s{k} on s{k}.tree = r.tree and s{k}.place = r.place // {16**k}" for k in range(_TREE_LEVELS)]
    + [f"join top_step{k} t{k} on t{k}.one = 0 and t{k}.place = p.place // {16**k}" for k in range(_TOP_LEVELS)]
)

MERKLE = f"""
with leaves as (
    select doc_id, source, coalesce('s' || source, '') as tree, {_leaf("text")} as digest,
           case when crc % 5 = 0 then {_leaf("lowered")} else {_leaf("text")} end as shown
    from (select *, case when text is not null then {LOWERED} end as lowered,
                 {_crc32('doc_id::varchar')} as crc from documents)
), row0 as (
    select tree, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as place, * exclude (tree)
    from leaves
), {_tree("row", _TREE_LEVELS, "tree")},
top0 as (
    select 0 as one, row_number() over (order by tree) - 1 as place, tree, digest from row{_TREE_LEVELS}
), {_tree("top", _TOP_LEVELS, "one")}
select doc_id, source, leaf, subroot, root, sha256(siblings) as proof_sha256, folded as folded_root,
       folded = root as verified
from (
    select r.doc_id, r.source, r.digest as leaf, p.digest as subroot, t.digest as root,
           {" || ".join(f"{s}.before || {s}.after" for s in _STEPS)} as siblings,
           {", ".join(_FOLDS)}, {_LAST_FOLD} as folded
    from row0 r join top0 p on r.tree = p.tree, top{_TOP_LEVELS} t {_STEP_JOINS}
)
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_sharding": SHARDING,
    "op4_pii": PERSONAL,
    "op6_warc": WARC,
    "op7_decontamination": DECONTAMINATION,
    "op8_substring_dedup": SUBSTRINGS,
    "op10_near_dedup": NEAR,
    "op12_ranked_search": RANKED,
    "op13_merkle": MERKLE,
}
