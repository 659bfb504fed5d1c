"""The training-data pipeline: five stages over ``documents``, each written and read again.

Stages take the documents that the one before has kept, with whatever columns they
have, and give back the same columns; the last adds ``size``, ``shard`` and ``slot``
in place of any of that name.  Rows are told apart by all their columns, so rows that
repeat an id are documents of their own, and equal rows are copies.  A text that is
null or has no letter goes in the first stage, as its language cannot be told.  An
empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pingzones.llm import decontaminate, language, mixing, sharding, simhash
from pingzones.llm.catalog import SHARDS, table
from pingzones.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null texts, those without a letter or in doubt go."""
    return language.in_known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest id, null last, then the least row hash."""
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; items without a word have none."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a null source is one of its own."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there; copies each have a place."""
    return sharding.contiguous_shards(docs, SHARDS)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Models, random rounding and component search have no SQL form; tests/llm
# holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` that the stages keep, sharded; each stage but the last is written first."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
