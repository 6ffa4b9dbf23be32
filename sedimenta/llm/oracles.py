"""DuckDB SQL for the queries that SQL can express. Others are tested against brute force."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_REPEATS = rf"""
with words as (
  select doc_id, {_WORDS} as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as window_text
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)
), first as (
  select window_text, min(doc_id) as least from windows group by window_text
), gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from windows join first using (window_text) where least < doc_id
), places as (
  select doc_id, w, unnest(range(1, len(w) + 1)) as i from words
), left_over as (
  select p.doc_id, count(*) as n, count(g.i) as n_removed,
    coalesce(string_agg(p.w[p.i], ' ' order by p.i) filter (where g.i is null), '') as kept
  from places p left join gone g on p.doc_id = g.doc_id and p.i = g.i group by p.doc_id
)
select d.doc_id, coalesce(l.n, 0)::bigint as n_words, coalesce(l.n_removed, 0)::bigint as n_removed,
  sha256(coalesce(l.kept, '')) as kept_sha256
from words d left join left_over l using (doc_id)
"""

_LEAK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LEAKS = rf"""
with words as (
  select doc_id, regexp_extract_all({_LOWER}, '{_LEAK_WORD}') as w from documents
), items as (
  select item_id::varchar as item, regexp_extract_all({_LOWER}, '{_LEAK_WORD}') as w from benchmark
), windows as (
  select distinct item, least(len(w), 10) as size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as window_text
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
), sizes as (
  select distinct size from windows
), found as (
  select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as window_text
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size)
), met as (
  select doc_id, i, size, item from found join windows using (size, window_text)
), hits as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as place from met) group by doc_id
), owners as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item from met) group by doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
  coalesce(o.n_items, 0)::bigint as n_items, sha256(coalesce(o.ids, '')) as items_sha256,
  coalesce(h.n_hit, 0) > 0 as contaminated
from words w left join hits h using (doc_id) left join owners o using (doc_id)
"""

_MIX = rf"""
with docs as (
  select doc_id, source, len({_WORDS})::bigint as size from documents
), sources as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) as rank
  from docs group by source
), weighted as (
  select *, (rank - 1) % 3 + 1 as weight, sum(source_size) over () as total from sources
), filled as (
  select *, 3 * source_size * sum(weight) over (order by source_size / weight, rank rows between current row and unbounded following)
    <= weight * (total - coalesce(sum(3 * source_size) over (order by source_size / weight, rank rows between unbounded preceding and 1 preceding), 0)) as stops
  from weighted
), targets as (
  select source, rank, source_size, total, case when stops then (3 * source_size)::double else
    (weight * (total - coalesce(sum(3 * source_size) filter (where stops) over (), 0)))::double
      / (sum(weight) filter (where not stops) over ())::double end as target
  from filled
), placed as (
  select d.doc_id, d.size, t.* exclude (source) from docs d join targets t on d.source is not distinct from t.source
), queued as (
  select *, md5(doc_id::varchar) as digest,
    sum(size) over (partition by rank order by md5(doc_id::varchar), doc_id rows unbounded preceding) as upto
  from placed where size > 0
), timed as (
  select *, (e * source_size + upto)::double / target as finish from queued, range(3) as passes(e)
), taken as (
  select doc_id, size, total, sum(size) over (order by finish, rank, digest, doc_id rows unbounded preceding) as spent from timed
), passes as (
  select doc_id, count(*) as n from taken where spent <= total group by doc_id
)
select p.doc_id, p.size, p.source_size::bigint as source_size, p.target, (coalesce(n, 0) * p.size)::bigint as taken
from placed p left join passes using (doc_id)
"""

_COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
  select lang, sum(len(w))::bigint as n from words group by lang
), phrases as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as f
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from words, range(1, 5) sizes(size) where len(w) >= size)
  group by all having count(*) >= 30
), candidates as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as w from phrases where size >= 2
), cuts as (
  select lang, size, phrase, a, w, unnest(range(1, size)) as k from candidates
), scored as (
  select c.lang, c.size, c.phrase, c.a, c.k, x.f as l, y.f as r, 2000000::hugeint * c.a // (x.f::hugeint + y.f) as score
  from cuts c join phrases x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
    join phrases y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
  select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, a as longer
  from (select lang, w, a, sizes.size, unnest(range(1, c.size - sizes.size + 2)) as i
    from candidates c, range(2, 4) sizes(size) where sizes.size < c.size)
), longest as (
  select lang, phrase, max(longer) as longer from inside group by all
), ranked as (
  select o.*, row_number() over (partition by o.lang order by score desc, a desc, o.phrase) as rank
  from lowest o left join longest g on g.lang = o.lang and g.phrase = o.phrase
  where g.longer is null or 100::hugeint * g.longer < 80::hugeint * o.a
)
select r.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r.r::bigint as r, n, score::bigint as score
from ranked r join totals t on t.lang = r.lang where rank <= 2000
"""

_TRIE = r"""
with rows as (
  select conv_id, turn, strlen(coalesce(text, ''))::bigint as bytes,
    sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as digest
  from conversations where conv_id is not null
), turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, digest) as pos from rows
), convs as (
  select conv_id, count(*) as size, conv_id - conv_id % 5 as head,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)),
      4294967295) % 9 as h
  from turns group by conv_id
), given as (
  select c.*, least(h, coalesce(s.size, 0)) as given from convs c left join (select conv_id as head, size from convs) s using (head)
), rebuilt as (
  select g.conv_id, t.pos, t.digest, t.bytes from given g join turns t on t.conv_id = g.head and t.pos <= g.given
  union all
  select g.conv_id, t.pos - g.h + g.given, t.digest, t.bytes from given g join turns t on t.conv_id = g.conv_id and t.pos > g.h
), paths as (
  select conv_id, list(digest order by pos) as digests, list(bytes order by pos) as sizes, count(*) as length from rebuilt group by conv_id
), members as (
  select conv_id, 0 as depth, '' as node, null::varchar as parent, 0::bigint as bytes, coalesce(length, 0) as length
  from convs left join paths using (conv_id)
  union all
  select conv_id, d, md5(array_to_string(digests[1:d], ',')), case when d = 1 then '' else md5(array_to_string(digests[1:d - 1], ',')) end,
    sizes[d], length from (select *, unnest(range(1, length + 1)) as d from paths)
), nodes as (
  select node, depth, min(conv_id) as conv_id, any_value(parent) as parent, any_value(bytes) as bytes, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = length), '')) as ends_sha256
  from members group by node, depth
), children as (
  select parent, count(*) as n_children from nodes group by parent
), valued as (
  select n.*, coalesce(n_children, 0) as n_children from nodes n left join children c on c.parent = n.node
), subtrees as (
  select m.node, m.depth, sum((v.n_children = 0)::int) as n_leaves, sum((v.n_convs - 1) * v.bytes) as saved
  from valued v join members m on m.conv_id = v.conv_id and m.depth <= v.depth group by m.node, m.depth
)
select v.conv_id, v.depth::bigint as depth, p.conv_id as parent_conv_id, v.n_convs::bigint as n_convs, v.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, v.ends_sha256
from valued v join subtrees s on s.node = v.node and s.depth = v.depth left join nodes p on p.node = v.parent
"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": _REPEATS,
    "op5_source_mix": _MIX,
    "op8_decontaminate": _LEAKS,
    "op11_collocations": _COLLOCATIONS,
    "op13_conversation_trie": _TRIE,
}
