"""A corpus pipeline: five stages, each written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catlink import session
from catlink.llm import decontam, mixing, quality, sharding, simhash
from catlink.llm.common import table
from catlink.llm.queries import SHARDS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 3-word shingles link at 3 or fewer differing bits."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, checksum, shard and slot of each copy."""
    return sharding.assign(docs, sharding.layout(SHARDS)).drop("grown_shard")


STAGES = [
    ("quality classifier", quality_stage), ("SimHash near-dedup", near_duplicates_stage), ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage), ("sharding", sharding_stage),
]

ORACLE_SQL = None
"""A trained classifier has no SQL form; the stages are tested against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
