"""The operators over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samekin.llm.alignment import aligned_tokens
from samekin.llm.jaccard import near_duplicates
from samekin.llm.language_model import language_model_scores
from samekin.llm.mixing import mixing_rates
from samekin.llm.packing import pack_binary
from samekin.llm.pii import KINDS, joined, ordered, personal_spans, train_pii
from samekin.llm.quality import quality, train_quality
from samekin.llm.rules import weak_supervision
from samekin.llm.sharding import ROW_BYTES, histogram_shards
from samekin.llm.spelling import spelling_variants
from samekin.llm.topk import exact_top_k
from samekin.llm.training_order import records, training_shards
from samekin.llm.toxicity import toxicity, train_severity

SHARDS = 24
QUERY_STEP = 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors, F.col("vec_id") % QUERY_STEP == 0, k=20, scale=64)


OP1_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) q
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
  where a.vec_id % 20 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) "rank"
  from scored
)
select query_id, "rank", vec_id, score from ranked where "rank" <= 20
"""


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return histogram_shards(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record, read back from the shards."""
    return records(training_shards(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_severity(docs, _table(spark, sf_dir, "labels"))
    return toxicity(docs, model)


def op4_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_binary(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.drop("ids")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents
), i as (
  select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as k from w where len(words) > 0
), s as (select distinct doc_id, array_to_string(words[k:k + 4], ' ') as shingle from i
), n as (select doc_id, count(*) as n from s group by doc_id
), p as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), link as (
  select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y
  where 100 * shared >= 75 * (a.n + b.n - shared)
), reach(doc_id, label) as (
  select doc_id, doc_id from documents union select link.y, reach.label from reach join link on link.x = reach.doc_id
)
select doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(label) as component_id
from reach left join n using (doc_id) group by doc_id
"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_supervision(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing_rates(docs, _table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = personal_spans(docs, train_pii(docs))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return marked.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(ordered(F.concat("base", "added"))).alias("spans"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k_search": op1_top_k_search,
    "op2_training_order": op2_training_order,
    "op3_toxicity": op3_toxicity,
    "op4_binary_packing": op4_binary_packing,
    "op5_histogram_shards": op5_histogram_shards,
    "op6_quality": op6_quality,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_pii": op10_pii,
    "op11_alignment": op11_alignment,
    "op12_spelling": op12_spelling,
    "op13_language_model": op13_language_model,
}

ORACLE_SQL = {"op1_top_k_search": OP1_SQL, "op7_jaccard_join": OP7_SQL}
