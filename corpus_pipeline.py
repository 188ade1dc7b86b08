"""A corpus from raw documents: language, near duplicates, benchmark leaks, mix, shards.

Each stage takes what its predecessor kept and is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentilake.llm.common import read_table
from sentilake.llm.decontamination import clean
from sentilake.llm.language_id import identify, train
from sentilake.llm.mixing import mix
from sentilake.llm.near_duplicates import keep_one
from sentilake.llm.sharding import external_shuffle
from sentilake.session import materialize

SHARDS = 24


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model accepts; models learn from the labelled ones."""
    return identify(docs, train(docs)).where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, similarity 0.8)."""
    return keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the ratio of their sources' weights, up to two copies of each, in mix order."""
    return mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their slot there."""
    return external_shuffle(docs, SHARDS)


STAGES = [
    ("languages", languages),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("shards", shards),
]

#: Models and seeded hashes have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
