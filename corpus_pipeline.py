"""From raw documents to shards of a training mixture, in five stages.

Every stage takes (spark, docs, folder of the tables) and returns a table; it is written and
read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweir.llm import decontaminate, mixing, quality, sharding, simhash
from streamweir.llm.tables import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voting rules call good."""
    return quality.judged(docs).where("verdict.kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of 3-word shingles, links of at most two bits."""
    return simhash.one_of_each(docs, k=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.drawn(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    return sharding.sharded(docs, size)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("sharding", shards),
]

# fingerprints and the estimated accuracies of rules are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Workspace(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir))
    return docs
