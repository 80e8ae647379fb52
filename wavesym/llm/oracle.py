"""DuckDB SQL of the queries that SQL can express."""

EXACT_DEDUP = r"""
with normal as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
)
select doc_id,
       min(doc_id) over (partition by body) as keep_id,
       count(*) over (partition by body) as group_size,
       doc_id = min(doc_id) over (partition by body) as kept,
       sha256(body) as text_sha256
from normal
"""

MINHASH_NEAR_DEDUP = r"""
with recursive words as (
    select doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') as w
    from documents
),
shingles as (
    select doc_id,
           case when len(w) = 0 then []
                else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)])
           end as s
    from words
),
sizes as (select doc_id, len(s) as n from shingles),
single as (select doc_id, unnest(s) as shingle from shingles),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from single x join single y on x.shingle = y.shingle and x.doc_id < y.doc_id
    group by all
),
links as (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * shared.n >= 85 * (p.n + q.n - shared.n)
),
edges as (select a, b from links union select b, a from links),
reach as (
    select doc_id as a, doc_id as b from sizes
    union
    select reach.a, edges.b from reach join edges on reach.b = edges.a
)
select sizes.doc_id, any_value(sizes.n) as n_shingles, min(reach.b) as component_id,
       sizes.doc_id = min(reach.b) as kept
from sizes join reach on reach.a = sizes.doc_id
group by sizes.doc_id
"""

WARC_BUNDLES = """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
held as (
    select *, case when strlen(payload) >= 1000 then max(page_id) over (partition by payload) end as holder
    from payloads
)
select page_id, strlen(payload) as payload_bytes, sha1(payload) as payload_digest,
       case when holder <> page_id then 'revisit' else 'response' end as record_type,
       case when holder <> page_id then holder end as refers_to
from held
"""

PREFIX_TRIE = """
with own as (
    select conv_id, octet_length(encode(coalesce(text, ''))) as bytes,
           md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id,
           row_number() over (
               partition by conv_id
               order by turn nulls first, coalesce(role, ''),
                        md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
    from conversations where conv_id is not null
),
convs as (
    select conv_id,
           xor(list_reduce(
               list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1), lambda p: ascii(substr(cast(conv_id as varchar), p, 1))::bigint)),
               lambda a, b: list_reduce(
                   list_prepend(xor(a, b), range(8)),
                   lambda v, k: xor(v >> 1, case when v % 2 = 1 then 3988292384 else 0 end))), 4294967295) % 9 as h
    from (select distinct conv_id from own)
),
rebuilt as (
    select c.conv_id, o.pos, o.id, o.bytes from convs c join own o on o.conv_id = c.conv_id - c.conv_id % 5 and o.pos <= c.h
    union all
    select c.conv_id, o.pos - c.h + least(c.h, coalesce(b.n, 0)), o.id, o.bytes
    from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h
    left join (select conv_id, count(*) as n from own group by conv_id) b on b.conv_id = c.conv_id - c.conv_id % 5
),
prefixes as (
    select conv_id, pos as depth, bytes, md5(string_agg(id, '') over (partition by conv_id order by pos)) as node
    from rebuilt
    union all
    select conv_id, 0, 0, '' from convs
),
lengths as (select conv_id, max(depth) as n from prefixes group by conv_id),
nodes as (
    select node, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes
    from prefixes group by node
),
tree as (
    select n.*, p.node as parent from nodes n left join prefixes p on p.conv_id = n.conv_id and p.depth = n.depth - 1
),
children as (select parent as node, count(*) as n from tree where parent is not null group by parent),
sums as (
    select p.node, count(*) filter (c.n is null) as n_leaves, sum((t.n_convs - 1) * t.bytes) as saved
    from tree t left join children c on c.node = t.node
    join prefixes p on p.conv_id = t.conv_id and p.depth <= t.depth
    group by p.node
),
ended as (
    select p.node, string_agg(p.conv_id::varchar, ',' order by p.conv_id) as ids
    from prefixes p join lengths l on l.conv_id = p.conv_id and l.n = p.depth
    group by p.node
)
select t.conv_id, t.depth::bigint as depth, u.conv_id as parent_conv_id, t.n_convs, coalesce(c.n, 0) as n_children,
       s.n_leaves, s.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from tree t left join nodes u on u.node = t.parent left join children c on c.node = t.node
join sums s on s.node = t.node left join ended e on e.node = t.node
"""

PHRASE_MINING = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, k, w[i:i + k - 1] as g
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (select unnest(range(1, 6)) as k))
),
f as (select lang, k, array_to_string(g, ' ') as phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 100),
cuts as (
    select c.lang, c.phrase, c.a, cut, x.f as l, y.f as r, t.n,
           (1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as score
    from (select *, unnest(range(1, k)) as cut from candidates) c
    join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ')
    join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
    join totals t on t.lang = c.lang
),
least as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
held as (
    select distinct c.lang, c.phrase
    from candidates c join candidates b on b.lang = c.lang and b.k > c.k
    where contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') and 100 * b.a >= 100 * c.a
),
ranked as (
    select s.*, row_number() over (partition by s.lang order by s.score desc, s.a desc, encode(s.phrase)) as rank
    from least s left join held h on h.lang = s.lang and h.phrase = s.phrase
    where h.phrase is null
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000
"""

CHAT_FORMATTING = """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
),
controls as (
    select unnest(['<|turn|>', '<|says|>', '<|end|>', '</s>', '<s>', '[INST]', '[/INST]', '<|endoftext|>', '\u241b']) as c
),
sized as (
    select *, length(role) + length(text) + 8 + 8 + 7
           + (select sum((length(role || ' ' || text) - length(replace(role || ' ' || text, c, ''))) // length(c))::bigint
              from controls) as size
    from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), ''))
           as loss_sha256,
       sum(size)::bigint as formatted_chars
from sized group by conv_id
"""

ORACLE_SQL = {
    "op13_chat_formatting": CHAT_FORMATTING,
    "op12_phrase_mining": PHRASE_MINING,
    "op11_prefix_trie": PREFIX_TRIE,
    "op1_minhash_near_dedup": MINHASH_NEAR_DEDUP,
    "op6_warc_bundles": WARC_BUNDLES,
    "op10_exact_dedup": EXACT_DEDUP,
}
