"""A corpus pipeline of five of the training-data operators, from documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkspark.llm.common import delete, stash
from linkspark.llm.host_rules import keep_good
from linkspark.llm.mixing import mix
from linkspark.llm.near_dedup import deduplicate
from linkspark.llm.packing import pack
from linkspark.llm.pii import redact
from linkspark.llm.queries import table, tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that aren't bad."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences."""
    return pack(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: Mixing and packing can't be expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again, and removed when the next is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
        delete(before)
    return STAGES[-1][1](spark, docs, sf_dir)
