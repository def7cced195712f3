"""Mixing sources to target weights, cut at exact budgets.

Every document gets a hash-random key. Documents are range-sorted by (source, key), and
distributed prefix sums of their word counts (`common.ranked`) place each one in its
source's stream of words. A source's budget is met by whole passes over its stream, then
by the words in front of the cut; the document at the cut gives the words that are missing.
A hot source is many range parts, none of them more than its share.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share the words of
all documents. A target stops at 3 times its source's words; the excess goes to the others
by weight until none is above.

Defined results: null or blank text has no words and nothing is taken from it; a null
source is a source of its own, the last; documents with the same id share their random
key and are told apart by size; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import BLANKS, ranked, stored

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = "mix"


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, start, target): what to take from each source.

    Each round shares what capped sources leave over; the rounds end when no share is above
    its cap. A round is one aggregation over the table of sources.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = ranked(
        sizes, F.col("source").asc_nulls_last(), measures={"size": F.col("source_size")}
    )
    given = ", ".join(str(int(w)) for w in weights)
    table = stored(
        order.select(
            "source",
            "source_size",
            F.col("size_before").alias("start"),
            F.expr(f"array({given})[cast(rank % {len(weights)} as int)]").alias("weight"),
        )
    )
    cap = f"cast({most} * source_size as decimal(38, 0))"
    total = int(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    left, share = total, int(table.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0])
    while True:
        above = f"{cap} * {share} < cast(weight as decimal(38, 0)) * {left}"
        capped, rest = table.agg(
            F.expr(f"coalesce(sum(if({above}, {most} * source_size, 0)), 0)"),
            F.expr(f"coalesce(sum(if({above}, 0, weight)), 0)"),
        ).first()
        if total - int(capped) == left or not rest:
            break
        left, share = total - int(capped), int(rest)
    target = f"if({above}, cast({most} * source_size as double), cast(weight * {left}L as double) / {max(share, 1)})"
    return stored(table.select("source", "source_size", "start", F.expr(target).alias("target")))


def mix(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(row, size, source_size, target, taken): words of each document that the mix takes."""
    keep = list(docs.columns if keep is None else keep)
    sized = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        docs[doc].alias("doc"),
        docs[source].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs[text], F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(docs[doc].cast("string"), F.lit("")))).alias("key"),
    )
    order = ranked(
        sized,
        F.col("source").asc_nulls_last(),
        F.col("key").asc(),
        F.col("doc").asc_nulls_last(),
        F.col("size").asc(),
        measures={"size": F.col("size")},
    )
    targets = source_targets(order, weights, most)
    named = broadcast_if_small(targets.withColumnRenamed("source", "name"))
    budget = F.round("target").cast("bigint")
    epochs = F.expr("if(source_size > 0, cast(round(target) as bigint) div source_size, 0L)")
    return (
        order.join(named, order["source"].eqNullSafe(F.col("name")))
        .withColumn("passes", epochs)
        .withColumn("rest", budget - F.col("passes") * F.col("source_size"))
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (
                F.col("passes") * F.col("size")
                + F.expr("greatest(0L, least(size, rest - (size_before - start)))")
            ).alias("taken"),
        )
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: a document as many times as its words are taken, texts whole.

    The document at a cut stays if at least half of its words are in front of it. Documents
    without words cost nothing and stay once.
    """
    copies = F.expr("if(size = 0, 1L, taken div size + if(2 * (taken % size) >= size, 1, 0))")
    return (
        mixed.withColumn("copies", copies)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("epoch"))
        .select("row.*")
    )
