"""The operators as queries over the driver's tables; names carry the number of the operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, conversations, hard_negatives, html_text, jaccard_join, lm_scoring, neighbours, packing, quality, sharding, simhash, suffixes, warc
from .oracles import CONVERSATIONS, HARD_NEGATIVES, JACCARD


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
    return quality.judged(_documents(spark, sf_dir)).select(F.col("_id").alias("doc_id"), *columns)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.exact_shards(_documents(spark, sf_dir))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id")
    return lm_scoring.cross_entropy_difference(_documents(spark, sf_dir), good)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return suffixes.without_repeats(_documents(spark, sf_dir)).select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir)).select(F.col("_id").alias("doc_id"), simhash.hex_digits("_fp").alias("fingerprint"), F.col("component").alias("component_id"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.encode(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    digest = F.sha2(F.array_join("ids", " "), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", moved), "id % 50 = 0")
    return found.withColumn("rank", F.col("rank").cast("int"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.repaired_conversations(turns, gone="gone")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(_documents(spark, sf_dir))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_quality, op3_warc, op4_sharding, op5_lm_scoring, op6_neighbours, op7_suffixes, op8_html, op9_simhash, op10_byte_bpe, op11_hard_negatives, op12_conversations, op13_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": _WARC_SQL, "op11_hard_negatives": HARD_NEGATIVES, "op12_conversations": CONVERSATIONS, "op13_jaccard_join": JACCARD}


#: Base32 of a SHA-1 from its hex digits: five of them are four characters.
_WARC_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
d as (
  select page_id, n, h, list_reduce(list_transform(range(0, 8), lambda i: list_reduce(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::int >> (15 - 5 * j)::int) & 31), 1)), lambda a, b: a || b)), lambda a, b: a || b) as digest,
    max(page_id) over (partition by h, n) as last
  from p)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id = last then null else last end as refers_to
from d
"""
