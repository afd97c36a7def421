"""The operators' queries by name, over the tables of a data folder, with SQL where it can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.catalog.base import Query
from saleslayers.llm import alignment, decontamination, hard_negatives, language_id, near_duplicates, packing, pii, quality_rules, repeated_text, sharding, sql, suffix_tree, token_files, tokens, url_filter
from saleslayers.llm.common import table
from saleslayers.session import scratch_path


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), into="q")
    return judged.select("doc_id", *[f"q.{f}" for f in fields])


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"), held_out)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.shard(narrow, ["doc_id", "text_crc32", "size"], shards=40)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = token_files.write_ids(docs, folder, tokens.default_tokenizer(), end_id=2)
    return token_files.read_ids(spark, folder, parts)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokens.default_tokenizer(), end_id=1, capacity=2048)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.link(table(spark, sf_dir, "documents"))


#: The rules of the page query.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, model).drop("block_probability")


def op10_repeated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_text.deduplicate(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return language_id.identify(table(spark, sf_dir, "documents"), held_out)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *alignment.default_tokenizers())


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", relabelled), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_pii": Query(op1_pii),
    "op2_quality_rules": Query(op2_quality_rules, sql.OP2),
    "op3_suffix_tree": Query(op3_suffix_tree),
    "op4_decontamination": Query(op4_decontamination, sql.OP4),
    "op5_sharding": Query(op5_sharding),
    "op6_token_ids": Query(op6_token_ids),
    "op7_packing": Query(op7_packing),
    "op8_near_duplicates": Query(op8_near_duplicates, sql.OP8),
    "op9_url_filter": Query(op9_url_filter),
    "op10_repeated_text": Query(op10_repeated_text),
    "op11_language_id": Query(op11_language_id),
    "op12_alignment": Query(op12_alignment),
    "op13_hard_negatives": Query(op13_hard_negatives, sql.OP13),
}
