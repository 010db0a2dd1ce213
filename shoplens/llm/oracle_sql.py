"""DuckDB SQL for the corpus queries that SQL can express."""

OP3_SQL = r"""
with docs as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
flat as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from docs),
three as (
  select doc_id, pos,
         word || ' ' || lead(word, 1) over w || ' ' || lead(word, 2) over w as win
  from flat window w as (partition by doc_id order by pos)),
seen as (
  select doc_id, pos,
         win is not null and count(*) over (partition by doc_id, win) > 1 as repeated from three),
covered as (
  select doc_id, max(cast(repeated as int)) over
    (partition by doc_id order by pos rows between 2 preceding and current row) as hit from seen),
repeats as (select doc_id, sum(hit) as n from covered group by doc_id),
m as (
  select docs.doc_id,
         cast(len(words) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(repeats.n, 0) as bigint) as n_repeat_words,
         cast(len(lines) as bigint) as n_lines,
         (length(text) - length(replace(text, '!!', ''))) // 2 as n_shouts
  from docs left join repeats on docs.doc_id = repeats.doc_id),
led as (
  select *, cast(
    case when n_words < 50 then 1 else 0 end
    + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    + case when 4 * n_symbols > n_words then 4 else 0 end
    + case when n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines then 8 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 25 * n_words then 16 else 0 end
    + case when 4 * n_shouts > n_words then 32 else 0 end as int) as failures from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) <> 0 as base_failed, failures = 0 as kept, failures,
       case failures when 1 then 'min_words' when 2 then 'repeat_words' when 4 then 'symbols' when 8 then 'dup_lines'
                     when 16 then 'word_length' when 32 then 'shouting' end as alone,
       case when failures in (1, 2, 4, 8, 16, 32) then count(*) over (partition by failures) end as alone_docs,
       case when failures in (1, 2, 4, 8, 16, 32)
            then cast(sum(n_words) over (partition by failures) as bigint) end as alone_words
from led
"""

OP10_SQL = r"""
with p as (
  select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
d as (
  select page_id, url, html, octet_length(encode(html)) as n,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast((cast('0x' || substr(h, cast(5 * (i // 4) + 1 as bigint), 5) as bigint)
                 >> cast(5 * (3 - i % 4) as bigint)) & 31 as bigint) + 1, 1)), 'string_agg', '') as digest
  from p),
f as (
  select *, first_value(page_id) over w as first, first_value(url) over w as first_url
  from d window w as (partition by digest order by page_id)),
i as (
  select *, md5(concat(coalesce(cast(page_id as varchar), '-'), chr(10), coalesce(url, '-'), chr(10), '1')) as own,
         md5(concat(coalesce(cast(first as varchar), '-'), chr(10), coalesce(first_url, '-'), chr(10), '1')) as other
  from f),
t as (
  select *, page_id <> first as again, chr(13) || chr(10) as nl,
         concat('<urn:uuid:', own[1:8], '-', own[9:12], '-', own[13:16], '-', own[17:20], '-', own[21:32], '>') as own_id,
         concat('<urn:uuid:', other[1:8], '-', other[9:12], '-', other[13:16], '-', other[17:20], '-', other[21:32], '>') as other_id
  from i),
r as (
  select *, concat('WARC/1.1', nl, 'WARC-Type: ', if(again, 'revisit', 'response'), nl, 'WARC-Record-ID: ', own_id, nl,
      'WARC-Date: 1970-01-01T00:00:00Z', nl,
      if(url is null, '', 'WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A') || nl),
      'WARC-Payload-Digest: sha1:', digest, nl,
      if(again, 'WARC-Refers-To: ' || other_id || nl
        || 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl
        || 'Refers-To-Page: ' || first || nl, ''),
      'Page: ', page_id, nl, 'Content-Type: text/html; charset=utf-8', nl,
      'Content-Length: ', if(again, 0, n), nl, nl, if(again, '', html), nl, nl) as record
  from t)
select page_id, cast(octet_length(encode(record)) as bigint) as record_bytes, sha256(record) as record_sha256, cast(n as bigint) as payload_bytes, digest as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from r
"""

OP12_SQL = r"""
with v as (
  select cast(vec_id as bigint) as id,
         case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else cast(label as bigint) end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.id as anchor, b.id as other, a.label = b.label as same,
         cast(list_dot_product(a.q, b.q) as bigint) as score
  from v as a join v as b on a.id % 100 = 0 and a.id <> b.id),
positives as (
  select anchor, other, score from pairs where same
  qualify row_number() over (partition by anchor order by score desc, other) <= 5)
select p.anchor as anchor_id, p.other as positive_id,
       cast(row_number() over (partition by p.anchor, p.other order by n.score desc, n.other) as int) as rank,
       n.other as negative_id, p.score as positive_score, n.score as negative_score
from positives as p join pairs as n
  on n.anchor = p.anchor and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""


def _marked(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"case when {value} is null then '-' else concat(strlen({text}), ':', {text}) end"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_marked(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


def _levels(name: str, height: int) -> str:
    """CTEs over ``name``0 (g, idx, digest, n): the nodes of each level above, and beside
    every node its siblings (lhs, rhs) where its group has more than one node left."""
    ctes = []
    for k in range(height):
        run = "partition by g, idx // 8 order by idx rows between"
        ctes.append(f"""
{name}{k}s as (
  select *, n > 1 as joined,
         case when n > 1 then coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') end as lhs,
         case when n > 1 then coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') end as rhs
  from {name}{k}),
{name}{k + 1} as (
  select g, idx // 8 as idx, case when any_value(n) > 1 then sha256(string_agg(digest, '' order by idx))
                             else any_value(digest) end as digest, (any_value(n) + 7) // 8 as n
  from {name}{k} group by g, idx // 8)""")
    return ",".join(ctes)


# levels unrolled: enough for 8**9 documents of a language and 8**3 languages
GROUP_LEVELS, ROOT_LEVELS = 9, 3
_CRC_STEP = "xor(a >> 1, 3988292384 * (a & 1))"
_CRC32 = f"""xor(4294967295, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
    lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {_CRC_STEP}, xor(crc, byte)), 4294967295))"""


def _op13_sql() -> str:
    steps = [f"g{k}" for k in range(GROUP_LEVELS)] + [f"r{k}" for k in range(ROOT_LEVELS)]
    joins = "\n".join(f"left join g{k}s as g{k} on g{k}.g = leaves.g and g{k}.idx = leaves.idx // {8 ** k}"
                      for k in range(GROUP_LEVELS))
    joins += "\n" + "\n".join(f"left join r{k}s as r{k} on r{k}.idx = seats.idx // {8 ** k}" for k in range(ROOT_LEVELS))
    proof = " || ".join(f"coalesce({s}.lhs || {s}.rhs, '')" for s in steps)
    folds, told = [], "told"
    for i, s in enumerate(steps):
        folds.append(f"f{i} as (select *, case when {s}_lhs is not null then sha256({s}_lhs || {told} || {s}_rhs) "
                     f"else {told} end as t{i} from {f'f{i - 1}' if i else 'located'})")
        told = f"t{i}"
    sides = ", ".join(f"{s}.lhs as {s}_lhs, {s}.rhs as {s}_rhs" for s in steps)
    return f"""
with rows as (
  select doc_id, {_leaf("text")} as leaf, coalesce('1' || lang, '0') as g,
         case when doc_id is not null and {_CRC32} % 3 = 0 then {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as changed
  from documents),
leaves as (
  select doc_id, leaf, coalesce(changed, leaf) as told, g,
         row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by g) as n from rows),
g0 as (select g, idx, leaf as digest, n from leaves),{_levels("g", GROUP_LEVELS)},
seats as (select g as lang_key, 'root' as g, row_number() over (order by encode(g)) - 1 as idx, digest,
                 count(*) over () as n from g{GROUP_LEVELS}),
r0 as (select g, idx, digest, n from seats),{_levels("r", ROOT_LEVELS)},
located as (
  select leaves.doc_id, leaves.leaf, leaves.told, seats.digest as subroot, top.digest as root,
         sha256({proof}) as proof_sha256, {sides}
  from leaves join seats on seats.lang_key = leaves.g
{joins}
  cross join r{ROOT_LEVELS} as top),
{", ".join(folds)}
select doc_id, leaf, subroot, root, proof_sha256, {told} as folded_root, {told} = root as verified from f{len(steps) - 1}
"""


OP13_SQL = _op13_sql()
