"""A corpus from raw documents to packed sequences: one stage after the other, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleslayers.llm import decontamination, near_duplicates, packing, pii, quality_rules, tokens
from saleslayers.llm.common import release, table, written

#: End id and length of the packed sequences.
END_ID, CAPACITY = 1, 2048


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return quality_rules.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return near_duplicates.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms replaced."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack_documents(docs, tokens.default_tokenizer(), END_ID, CAPACITY)


STAGES = [
    ("quality_rules", clean_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("packing", pack),
]

#: Packing needs a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. The result is read from the last stage's table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
