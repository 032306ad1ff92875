"""One query for each operator, over its whole table, and the DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import (
    chat,
    collocations,
    decontaminate,
    lattice,
    licenses,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    sharding,
    token_counts,
    token_files,
    warc,
)
from lendscope.llm.common import table
from lendscope.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = packing.lengths(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(measured)


@_query
def op2_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"), words=4, percent=85)


ORACLE["op3_jaccard_join"] = r"""
with recursive given as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, unnest(
    case when len(w) = 0 then []
         when len(w) < 4 then [array_to_string(w, ' ')]
         else [array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)] end) as s
  from given
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
  group by 1, 2
), links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)
), sides as (select a, b from links union all select b, a from links),
reach(a, b) as (
  select a, b from sides
  union
  select r.a, l.b from reach r join sides l on r.b = l.a
), least_of as (select a, min(b) as m from reach group by a)
select g.doc_id, coalesce(n, 0) as n_shingles, coalesce(least(g.doc_id, m), g.doc_id) as component_id
from given g left join sizes s on s.doc_id = g.doc_id left join least_of r on r.a = g.doc_id
"""


@_query
def op4_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


ORACLE["op4_lattice_dedup"] = """
with recursive usable as (
  select vec_id, label, cast(embedding as double[]) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0
), links as (
  select a.vec_id as a, b.vec_id as b
  from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) as (
  select a, b from links
  union
  select r.a, l.b from reach r join links l on r.b = l.a
), least_of as (select a, min(b) as m from reach group by a),
counted as (select a, count(*) as n from links group by a)
select e.vec_id,
  coalesce(c.n, 0) as n_links,
  coalesce(least(e.vec_id, r.m), e.vec_id) as component_id,
  e.vec_id = coalesce(least(e.vec_id, r.m), e.vec_id) as kept
from embeddings e left join counted c on c.a = e.vec_id left join least_of r on r.a = e.vec_id
"""


@_query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    hostile = spark.createDataFrame(
        [(-7, 0, "user", says), (-7, 1, "assistant", says)], given.schema
    )
    read = chat.read_back(chat.format_conversations(given.unionByName(hostile)))
    turns = F.array_join(
        F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
        ),
        "",
    )
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE["op5_chat_format"] = r"""
with rows_given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, k, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(k, r)
), marked as (
  select *,
    case when role in ('system', 'user', 'assistant') then length(role) else null end as role_chars,
    coalesce(role <> lag(role) over w, true) as opens,
    length(replace(replace(replace(replace(
      text, '\', '\b'), '###', '\h'), '</turn>', '\e'), '<|>', '\n')) as shown
  from rows_given
  window w as (partition by conv_id order by turn, role, text)
)
select conv_id,
  count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text)
    filter (where role = 'assistant'), '')) as loss_sha256,
  -- a message: '### ', role, ': ', texts, ' </turn>' and a line end; '<|>' between its texts
  cast(sum(shown + case when opens then 4 + role_chars + 2 + 9 else 3 end) as bigint)
    as formatted_chars
from marked
group by conv_id
"""


@_query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    # Documents lie in the directories of their source and language. A source that names a licence
    # file is that file; of documents without file names, none passes its own licence on.
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    is_file = F.contains("source", F.lit("/")) & F.col("source").rlike(licenses.LICENSE_NAMES)
    path = F.when(is_file, F.col("source")).otherwise(path)
    return licenses.scan(documents, "doc_id", "text", path, named_only=True)


@_query
def op6_page_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of pages, whose urls are paths: a page without one inherits that of the licence file
    in its nearest directory. Rows are as many as pages; `doc_id` is the page_id."""
    pages = table(spark, sf_dir, "pages")
    # Host and path, without scheme, query and fragment.
    path = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    # What is shown, each element on lines of its own.
    shown = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "\n")
    shown = F.trim(F.regexp_replace(F.regexp_replace(shown, r"<[^<>]*>", "\n"), r"\s*\n\s*", "\n"))
    rows = pages.select("page_id", path.alias("place"), shown.alias("shown"))
    return licenses.scan(rows, "page_id", "shown", F.col("place"), named_only=True)


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return quality.score(documents, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=2)
    return token_files.read_digests(spark, folder)


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_counts.context_table(token_counts.histogram(documents, tokenizer_path()))


@_query
def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op11_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.resolved(warc.read_records(spark, folder))


ORACLE["op11_seekable_warc"] = """
with given as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
), targets as (
  select html, max(page_id) as target, count(*) as copies from given where payload_bytes >= 1000 group by html
)
select g.page_id, g.payload_bytes, sha1(g.html) as payload_digest,
  case when t.copies > 1 and g.page_id is distinct from t.target and t.target is not null
    then 'revisit' else 'response' end as record_type,
  case when t.copies > 1 and g.page_id is distinct from t.target then t.target end as refers_to
from given g left join targets t on t.html = g.html
"""


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = """
with given as (
  select conv_id, role, text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
  from (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
  )
), convs as (
  select conv_id, conv_id - conv_id % 100 as base,
    -- crc32 of the decimal id, bit by bit
    xor(list_reduce(
      [4294967295] || list_transform(range(length(conv_id::varchar)),
        lambda i: ascii(substr(conv_id::varchar, i + 1, 1))),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
    ), 4294967295) % 6 as h
  from (select distinct conv_id from given)
), rebuilt as (
  select conv_id, role, text, row_number() over (partition by conv_id order by side, pos) as depth
  from (
    select c.conv_id, 0 as side, g.pos, g.role, g.text
    from convs c join given g on g.conv_id = c.base and g.pos <= c.h
    union all
    select c.conv_id, 1, g.pos, g.role, g.text
    from convs c join given g on g.conv_id = c.conv_id and g.pos > c.h
  )
), paths as (
  select conv_id, depth, length(text) as chars,
    sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') over (
      partition by conv_id order by depth rows unbounded preceding)) as key
  from rebuilt
  union all
  select conv_id, 0, 0, '' from convs
), nodes as (
  select key, depth, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars
  from paths group by key, depth
), lineage as (
  select n.key, n.depth, p.key as top_key, p.depth as top_depth
  from nodes n join paths p on p.conv_id = n.conv_id and p.depth <= n.depth
), children as (
  select top_key, top_depth, count(*) as n_children
  from lineage where depth = top_depth + 1 group by top_key, top_depth
), sums as (
  select l.top_key, l.top_depth, count(*) filter (where c.n_children is null) as n_leaves,
    sum((n.n_convs - 1) * n.chars) as saved_tokens
  from lineage l join nodes n on n.key = l.key and n.depth = l.depth
  left join children c on c.top_key = l.key and c.top_depth = l.depth
  group by l.top_key, l.top_depth
), ends as (
  select p.key, p.depth, string_agg(p.conv_id::varchar, ',' order by p.conv_id) as ids
  from paths p join (select conv_id, max(depth) as depth from paths group by conv_id) last
    on last.conv_id = p.conv_id and last.depth = p.depth
  group by p.key, p.depth
)
select n.conv_id, cast(n.depth as bigint) as depth, parent.conv_id as parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0) as n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n
join sums s on s.top_key = n.key and s.top_depth = n.depth
left join children c on c.top_key = n.key and c.top_depth = n.depth
left join lineage up on up.key = n.key and up.depth = n.depth and up.top_depth = n.depth - 1
left join nodes parent on parent.key = up.top_key and parent.depth = up.top_depth
left join ends e on e.key = n.key and e.depth = n.depth
"""


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5)
    return collocations.best(found, 2000)


ORACLE["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) as phrase
  from words cross join (select unnest(range(1, 6)) as k)
), counted as (
  select lang, k, phrase, count(*) as f from grams group by lang, k, phrase
), totals as (
  select lang, cast(sum(f) as bigint) as n from counted where k = 1 group by lang
), candidates as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k >= 2 and f >= 100
), cuts as (
  select lang, k, phrase, a, j, array_to_string(w[1:j], ' ') as front, array_to_string(w[j + 1 :], ' ') as rest
  from (select *, unnest(range(1, k)) as j from candidates)
), scored as (
  select c.lang, c.phrase, c.a, c.j, x.f as l, y.f as r, t.n,
    cast((1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as bigint) as score
  from cuts c join totals t on t.lang = c.lang
  join counted x on x.lang = c.lang and x.k = c.j and x.phrase = c.front
  join counted y on y.lang = c.lang and y.k = c.k - c.j and y.phrase = c.rest
), lowest as (
  select *, row_number() over (partition by lang, phrase order by score, j) as place from scored
), kept as (
  select lang, phrase, a, l, r, n, score from lowest where place = 1 and not exists (
    select 1 from candidates b
    where b.lang = lowest.lang and 100 * b.a >= 100 * lowest.a and len(b.phrase) > len(lowest.phrase)
      and contains(' ' || b.phrase || ' ', ' ' || lowest.phrase || ' '))
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""
