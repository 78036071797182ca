"""The text operators over their whole tables, under the names and with the columns of the driver's contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import (
    bpe_codec,
    decontam_cgk,
    euler_trie,
    hard_negatives,
    langid,
    license_scan,
    multi_index,
    rp_forest,
    secret_cnn,
    sharding,
    simhash_bk,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_label_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


@query
def op7_bpe_codec(spark, sf_dir):
    return bpe_codec.encode_digests(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def toxic_models(docs: DataFrame, sf_dir: str):
    """The character model of docs, and the toxicity model fitted on their labelled training rows."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet")
    character = toxicity.character_model(docs)
    return character, toxicity.fit(docs, toxicity.training_labels(labels), character)


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op3_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, *toxic_models(docs, sf_dir))
    return scored.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op4_simhash_bk(spark, sf_dir):
    return simhash_bk.near_duplicates(documents(spark, sf_dir))


@query
def op5_license_scan(spark, sf_dir):
    return license_scan.scan_digest(documents(spark, sf_dir))


@query
def op6_rp_forest(spark, sf_dir):
    return rp_forest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op8_decontamination(spark, sf_dir):
    """A row for each document and benchmark item it holds, with the best place."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam_cgk.best_places(decontam_cgk.find(documents(spark, sf_dir), benchmark))


@query
def op9_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    profiles = langid.learn(docs.where(_remainder(4) != 2))
    return langid.identify(docs, profiles).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op10_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return secret_cnn.scan(docs, secret_cnn.fit(docs))


@query
def op11_prefix_trie(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return euler_trie.trie(euler_trie.rebuilt(euler_trie.number_turns(conversations)))


@query
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_multi_index(spark, sf_dir):
    return multi_index.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# Whole numbers below 2^53, so inner products of doubles are exact.
ORACLE_SQL["op12_hard_negatives"] = """
with v as (
  select distinct vec_id as id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0),
s as (
  select a.id as anchor_id, a.label = b.label as same, b.id, list_inner_product(a.x, b.x)::bigint as score
  from v a join v b on a.id <> b.id where a.id % 50 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
       id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""


# CRC-32 bit by bit; a prefix is the text of its turns' digests; a node's ancestors are the prefixes of its smallest member.
ORACLE_SQL["op11_prefix_trie"] = """
with t as (
  select conv_id, coalesce(text, '') as x, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as code,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as nth
  from conversations where conv_id is not null),
c as (
  select conv_id, n, conv_id - conv_id % 100 as first, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(8 * length(s)), lambda i: (ascii(s[(i // 8 + 1)::int]) >> (i % 8)::int) & 1)),
           lambda a, b: case when (a & 1) <> b then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 6 as h
  from (select conv_id, conv_id::varchar as s, count(*) as n from t group by 1)),
r as (
  select c.conv_id, t.nth as d, code, x from c join t on t.conv_id = c.first and t.nth <= h
  union all
  select c.conv_id, t.nth - c.h + least(c.h, coalesce(b.n, 0)), code, x
  from t join c on t.conv_id = c.conv_id left join c b on b.conv_id = c.first where t.nth > c.h),
p as (
  select conv_id, d, string_agg(code, '') over (partition by conv_id order by d) as key, x from r
  union all select conv_id, 0, '', '' from c),
nodes as (select key, d, min(conv_id) as cid, count(*) as n, max(length(x)) as len from p group by 1, 2),
kin as (select left(key, (64 * (d - 1))::int) as key, count(*) as n_children from nodes where d > 0 group by 1),
u as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kin using (key)),
up as (select u.*, a.cid as above, a.d as above_d, a.key as above_key
       from u join p on p.conv_id = u.cid and p.d <= u.d join nodes a on a.key = p.key),
sub as (select above_key as key, sum((n_children = 0)::int)::bigint as n_leaves, sum((n - 1) * len)::bigint as saved_tokens, count(*) as size
        from up group by 1),
places as (select key, row_number() over (order by path) - 1 as place
           from (select key, list(above order by above_d) as path from up group by 1)),
ends as (select key, sha256(string_agg(p.conv_id::varchar, ',' order by p.conv_id)) as ends_sha256
         from p join (select conv_id, max(d) as d from p group by 1) l on l.conv_id = p.conv_id and l.d = p.d group by 1)
select u.cid as conv_id, u.d::bigint as depth, a.cid as parent_conv_id, u.n as n_convs, u.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) as ends_sha256, (2 * place - u.d)::bigint as enter_at, (2 * place - u.d + 2 * size - 1)::bigint as leave_at
from u join sub using (key) join places using (key) left join ends using (key)
left join nodes a on u.d > 0 and a.key = left(u.key, (64 * (u.d - 1))::int)
"""

# All pairs: what the search finds at its recall.
ORACLE_SQL["op13_multi_index"] = """
with recursive v as (
  select vec_id, embedding::double[] as x, embedding is not null and list_count(embedding) = len(embedding)
         and len(list_filter(embedding, lambda y: not isfinite(y))) = 0 and len(list_filter(embedding, lambda y: y <> 0)) > 0 as sound
  from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.sound and b.sound and a.vec_id <> b.vec_id
  and list_cosine_similarity(a.x, b.x) >= 0.9),
reach as (
  select vec_id as a, vec_id as b from v
  union select reach.a, links.b from reach join links on reach.b = links.a)
select vec_id, (select count(*) from links where a = vec_id) as n_links, min(reach.b) as component_id, vec_id = min(reach.b) as kept
from v join reach on reach.a = vec_id group by vec_id
"""
