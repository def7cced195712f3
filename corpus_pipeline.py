"""From raw documents to the shards of a training mix: five operators in a row.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before has kept, and
returns the columns of documents; the last one adds `shard` and `slot`. Tables are written
between the stages, so a lost executor costs one stage at most.

Null, empty and blank texts are rejected by the first stage only if the classifier's prior
says so; no later stage drops them. An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm import hilbert, jaccard_join, mixing, neighbours, winnowing
from wickwork.llm.common import bucket, written
from wickwork.llm.queries import table

#: The classifier is not expressed in SQL.
ORACLE_SQL = None

LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours vote for quality."""
    labels = table(spark, sf_dir, "labels").where(~bucket("doc_id", 5, 0))
    scored = neighbours.score(docs, labels)
    return scored.where(F.col("score") >= LEAST_QUALITY).select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    leaks = winnowing.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaks.where(F.size("spans") == 0).select("row.*")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix, repeated documents as repeated rows."""
    return mixing.mixed_rows(mixing.mix(docs))


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it; columns of these names are replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return hilbert.shard(docs, keep=kept).select("row.*", "shard", "slot")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
    ("hilbert_sharding", hilbert_sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
