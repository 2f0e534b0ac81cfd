"""The training-corpus pipeline: five stages over ``documents``, each a table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet below the checkpoint folder and read again as the next stage's docs. All
but the last return the columns of ``documents``; the last adds the shard.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import table
from quarry.llm.decontaminate import remove_leaks
from quarry.llm.mixing import mix_documents
from quarry.llm.queries import SHARDS
from quarry.llm.sharding import assign_shards
from quarry.llm.simhash_dedup import keep_one
from quarry.llm.toxicity import drop_toxic
from quarry.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come at their target weights: documents left out or repeated, up to three times."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document gets its shard by rendezvous hashing of its id."""
    return assign_shards(docs, [1.0] * SHARDS)


STAGES = [("toxicity", toxicity), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The stages learn a classifier and use 64-bit hashes that SQL has not: tested by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The stage tables stay below the checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
