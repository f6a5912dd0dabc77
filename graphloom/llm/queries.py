"""The registered queries of the corpus operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import decontam, embedding_dedup, hard_negatives, imatch, line_dedup, minhash_forest, mixing, prefix_trie, substring_dedup, token_output, toxicity, url_filter, warc
from graphloom.llm.common import new_path, table

URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_tokens(spark, path)


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = line_dedup.insert_documents(line_dedup.empty_state(spark, min_docs=10, min_chars=1), documents)
    out = line_dedup.clean_lines(documents, state)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.mix(documents)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.measured(warc.rebuilt_records(spark, path))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity.score(documents, model, 0.3)
    return out.select("doc_id", (toxicity.bucket(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=80)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contaminated(documents, table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(embeddings.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup, op2_url_filter, op3_token_output, op4_imatch, op5_line_dedup, op6_mixing, op7_warc, op8_toxicity, op9_minhash_forest, op10_decontamination,
            op11_hard_negatives, op12_prefix_trie, op13_embedding_dedup,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": SUBSTRING_SQL, "op2_url_filter": URL_SQL, "op5_line_dedup": LINE_SQL, "op7_warc": WARC_SQL, "op9_minhash_forest": NEAR_SQL,
        "op11_hard_negatives": HARD_SQL, "op12_prefix_trie": TRIE_SQL, "op13_embedding_dedup": VECTOR_SQL,
    }


SUBSTRING_SQL = r"""
with split as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
    select doc_id, unnest(range(1, len(w) - 48)) as i, w from split where len(w) >= 50
), windows as (
    select doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) as h from starts
), repeated as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as first from windows) where first < doc_id
), gone as (
    select distinct doc_id, i + k as p from repeated, (select unnest(range(0, 50)) as k)
), words as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from split
), judged as (
    select words.*, gone.p is not null as out from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p
), kept as (
    select doc_id, count(*)::bigint as n_words, count(*) filter (out)::bigint as n_removed,
           string_agg(word, ' ' order by p) filter (not out) as text
    from judged group by doc_id
)
select split.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from split left join kept on split.doc_id = kept.doc_id
"""

URL_SQL = """
with cut as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as after from pages
), parts as (
    select page_id,
           translate(regexp_extract(after, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(after, '^[^/?#]*([^?#]*)', 1) as path
    from cut
), judged as (
    select page_id, host, path,
           case when ('.' || host) like '%.example.org' and path like '/en/1%' then 'example.org/en/1'
                when ('.' || host) like '%.example.org' and path like '/es/%' then 'example.org/es/'
                when ('.' || host) like '%.com' and path like '/fr/%' then 'com/fr/'
                when ('.' || host) like '%.com' and path like '/de/%' then 'com/de/'
                when ('.' || host) like '%.org' and path like '/%' then 'org/' end as rule
    from parts
)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule,
       case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' else 'allow' end as verdict
from judged
"""

LINE_SQL = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as n
    from documents
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), frequent as (
    select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
), judged as (
    select k.*, f.key is not null as gone from keyed k left join frequent f on k.key = f.key
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

NEAR_SQL = r"""
with recursive split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from split where len(w) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
    select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)
), reach as (
    select doc_id as x, doc_id as y from documents union select reach.x, links.y from reach join links on reach.y = links.x
), least as (
    select x as doc_id, min(y) as component_id from reach group by x
)
select least.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, component_id = least.doc_id as kept
from least left join sizes on least.doc_id = sizes.doc_id
"""

WARC_SQL = """
with hashed as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex, min(page_id) over (partition by coalesce(html, '')) as first
    from pages
)
select page_id, strlen(html)::bigint as payload_bytes,
       translate(concat(to_base(('0x' || hex[1:10])::bigint, 32, 8), to_base(('0x' || hex[11:20])::bigint, 32, 8),
                        to_base(('0x' || hex[21:30])::bigint, 32, 8), to_base(('0x' || hex[31:40])::bigint, 32, 8)),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from hashed
"""

HARD_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor, a.label as own, r.vec_id as other, r.label, list_inner_product(a.q, r.q)::bigint as score
    from rows a join rows r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
), positives as (
    select * from (select *, row_number() over (partition by anchor order by score desc, other) as place from scored where label = own) where place <= 5
), hard as (
    select p.anchor as anchor_id, p.other as positive_id, p.score as positive_score, s.other as negative_id, s.score as negative_score,
           row_number() over (partition by p.anchor, p.other order by s.score desc, s.other) as rank
    from positives p join scored s on s.anchor = p.anchor and s.label <> s.own and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from hard where rank <= 10
"""

TRIE_SQL = """
with keyed as (
    select conv_id, turn, coalesce(text, '') as text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as key
    from conversations where conv_id is not null
), own as (
    select conv_id, strlen(text) as bytes, key, row_number() over (partition by conv_id order by turn nulls first, key) as pos from keyed
), convs as (
    select conv_id, conv_id - conv_id % 5 as base,
           xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda d: ord(d)::bigint)),
               lambda crc, d: list_reduce(list_prepend(xor(crc, d), range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))) % 9 as h
    from (select distinct conv_id from own)
), turns as (
    select c.conv_id, 0 as late, o.pos, o.key, o.bytes from convs c join own o on o.conv_id = c.base and o.pos <= c.h
    union all
    select c.conv_id, 1, o.pos, o.key, o.bytes from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h
), built as (
    select c.conv_id, coalesce(list(t.key order by t.late, t.pos) filter (t.key is not null), []) as keys,
           coalesce(list(t.bytes order by t.late, t.pos) filter (t.key is not null), []) as sizes
    from convs c left join turns t on t.conv_id = c.conv_id group by c.conv_id
), prefixes as (
    select conv_id, keys, sizes, unnest(range(0, len(keys) + 1)) as depth from built
), members as (
    select conv_id, depth, array_to_string(keys[1:depth], '') as node, array_to_string(keys[1:depth - 1], '') as parent,
           case when depth = 0 then 0 else sizes[depth] end as bytes, len(keys) = depth as ended
    from prefixes
), nodes as (
    select node, depth, min(conv_id) as conv_id, any_value(parent) as parent, count(*) as n_convs, any_value(bytes) as bytes,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
    from members group by node, depth
), families as (
    select parent, count(*) as n_children from nodes where depth > 0 group by parent
), sized as (
    select nodes.*, coalesce(n_children, 0) as n_children from nodes left join families on families.parent = nodes.node
), subtrees as (
    select a.node, count(*) filter (b.n_children = 0) as n_leaves, sum((b.n_convs - 1) * b.bytes) as saved from sized a join sized b on starts_with(b.node, a.node) group by a.node
)
select s.conv_id, s.depth::bigint as depth, p.conv_id as parent_conv_id, s.n_convs::bigint as n_convs, s.n_children::bigint as n_children,
       t.n_leaves::bigint as n_leaves, t.saved::bigint as saved_tokens, s.ends_sha256
from sized s join subtrees t on t.node = s.node left join sized p on s.depth > 0 and p.node = s.parent
"""

VECTOR_SQL = """
with recursive usable as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as x, b.vec_id as y from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98
), reach as (
    select vec_id as x, vec_id as y from embeddings union select reach.x, links.y from reach join links on reach.y = links.x
), least as (
    select x as vec_id, min(y) as component_id from reach group by x
), counts as (
    select x as vec_id, count(*) as n_links from links group by x
)
select least.vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, component_id = least.vec_id as kept
from least left join counts on counts.vec_id = least.vec_id
"""
