"""Corpus pipeline: documents through five operators, each stage written as Parquet and reread.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellmart.llm import decontam, mixing, quality, sharding, simhash
from wellmart.llm.common import read_table, shared_table
from wellmart.sources.sinks import CUTS, drop_cuts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go; a null text has no words, so it goes too."""
    return quality.kept_rows(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others stay as they are."""
    return decontam.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them: none to three times."""
    return mixing.mixed_rows(mixing.plan(docs))


def shuffle_and_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.sharded_rows(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shuffle_and_shard", shuffle_and_shard),
]

#: The mix and the shuffle draw from seeded hashes that SQL does not have; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage is written, what it was made from is deleted.

    What the last stage itself reads stays until its reader is done: ``sinks.scratch`` around the run deletes it.
    """
    docs, held = read_table(spark, sf_dir, "documents"), len(CUTS)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_cuts(spark, held, keep_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
