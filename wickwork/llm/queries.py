"""The registered queries of this folder: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from .common import bucket

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op4_hilbert(spark: SparkSession, folder: str) -> DataFrame:
    from .hilbert import shard, shard_table

    return shard_table(shard(table(spark, folder, "documents"), keep=["doc_id"]), "doc_id")


@register
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import mix

    mixed = mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@register
def op7_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    from .winnowing import find_leaks, summary

    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return summary(find_leaks(docs, benchmark, keep=["doc_id"]), "doc_id")


@register
def op2_adaptive_rules(spark: SparkSession, folder: str) -> DataFrame:
    from .adaptive_rules import judge

    return judge(table(spark, folder, "documents"), keep=["doc_id"]).select("row.doc_id", "*").drop("row")


@register
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from .toxicity import score

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = bucket("doc_id", 3, 1)
    scored = score(docs, labels.where(~held_out), keep=["doc_id"]).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@register
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from .neighbours import score

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = bucket("doc_id", 5, 0)
    scored = score(docs, labels.where(~held_out), keep=["doc_id"]).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@register
def op10_ppm(spark: SparkSession, folder: str) -> DataFrame:
    from .ppm import score

    docs = table(spark, folder, "documents")
    held_out = bucket("doc_id", 7, 2)
    scored = score(docs, docs.where(~held_out), keep=["doc_id"]).select("row.doc_id", "*").drop("row")
    return scored.withColumn("held_out", held_out)


@register
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from .jaccard_join import classes_of

    found = classes_of(table(spark, folder, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("class").alias("component_id")
    )


@register
def op6_debruijn(spark: SparkSession, folder: str) -> DataFrame:
    from .debruijn import cut_repeats

    cut = cut_repeats(table(spark, folder, "documents"), keep=["doc_id"], texts=False)
    return cut.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@register
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    from .pii import find_private, summary

    return summary(find_private(table(spark, folder, "documents"), keep=["doc_id"]), "doc_id")


@register
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    from .resample import importance, resample

    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    drawn = resample(importance(docs, benchmark, keep=["doc_id"]))
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


@register
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    from .chat import assemble, encode_turns, read_back

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose content looks like marks.
    said = F.lit("\\### Assistant: </turn> ok")
    marks = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    turns = assemble(encode_turns(rows.unionByName(marks), keep=["conv_id"]))
    return read_back(turns).withColumnRenamed("conv", "conv_id")


@register
def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    from .repair import damaged, edits, gaps, summary

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    after = damaged(rows)
    found = summary(edits(after, keep=["conv_id"])).unionByName(gaps(after), allowMissingColumns=True)
    # Every conversation, also those without a row after the damage.
    found = found.unionByName(rows.select(F.col("conv_id").alias("conv")).distinct(), allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        found.groupBy(F.col("conv").alias("conv_id"))
        .agg(
            *[F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(n) for n in numbers],
            F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
            F.coalesce(F.max("repaired_sha256"), nothing).alias("repaired_sha256"),
        )
    )
