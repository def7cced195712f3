"""Sharding along a Hilbert curve through document metadata.

Source, language, length and id are quantised to `2 ** BITS` levels each; the curve index
of the four levels (Skilling, "Programming the Hilbert curve", 2004) orders the documents,
and the order is cut into runs. Neighbours on the curve are close in every dimension, so
each run, and each file of it, holds narrow ranges of all four, and readers can skip files
by the minima and maxima of any of them. `write_shards` writes the runs, `file_ranges`
lists their ranges.

Shards are cut by the law `rows`: counts differ by one at most. Everything is built from
SQL functions; the order comes from one range sort (`common.ranked`).

Defined results: a null text has 0 bytes and crc 0; null source, language and id come last
in their dimension and in the order; repeated rows stay, each with its own slot; an empty
table gives no rows; fewer documents than shards leave the last shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import ranked, stored

SHARDS = 24
BITS = 5
OVERHEAD = 8

LEVELS = 1 << BITS
DIMENSIONS = ("source", "lang", "length", "id")


def depth_levels(df: DataFrame, column: str) -> DataFrame:
    """(value, level): distinct values in code point order, cut into levels of equal rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    total = df.count()
    order = ranked(counts, F.col("value").asc_nulls_last(), measures={"rows": F.col("rows")})
    return stored(
        order.select(
            "value", F.expr(f"cast(rows_before * {LEVELS} div {max(total, 1)} as int)").alias("level")
        )
    )


def curve_index(levels: str, count: int, bits: int = BITS) -> Column:
    """Position on the curve of an array of `count` levels of `bits` bits each."""
    steps = ", ".join(
        f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(count)
    )
    turned = f"""
        aggregate(array({steps}), {levels}, (x, s) -> transform(x, (v, j) ->
            case when (x[s.i] & s.q) <> 0 then if(j = 0, v ^ (s.q - 1), v)
                 when j = 0 or j = s.i then v ^ ((x[0] ^ x[s.i]) & (s.q - 1))
                 else v end))"""
    coded = f"transform(sequence(0, {count - 1}), j -> aggregate(slice(x, 1, j + 1), 0, (a, v) -> a ^ v))"
    flips = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    places = ", ".join(
        f"named_struct('b', {b}, 'i', {i})" for b in range(bits - 1, -1, -1) for i in range(count)
    )
    index = f"""
        aggregate(array({places}), 0L, (a, s) -> a * 2 + (shiftright(g[s.i] ^
            aggregate(array({flips}), 0, (t, q) -> if((g[{count - 1}] & q) <> 0, t ^ (q - 1), t)),
            s.b) & 1))"""
    # element_at(transform(array(e), x -> ...), 1) names the value of e once.
    gray = f"element_at(transform(array({turned}), x -> {coded}), 1)"
    return F.expr(f"element_at(transform(array({gray}), g -> {index}), 1)")


def curve(
    docs: DataFrame, *, doc: str, text: str, source: str, lang: str, keep: list[str]
) -> DataFrame:
    """(row, doc, size, crc, levels, hilbert) of each document."""
    plain = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        docs[doc].cast("bigint").alias("doc"),
        docs[source].cast("string").alias("source"),
        docs[lang].cast("string").alias("lang"),
        (F.octet_length(F.coalesce(docs[text], F.lit(""))) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("crc"),
    )
    ends = plain.agg(F.min("doc").alias("low"), F.max("doc").alias("high")).first()
    low, span = ends.low or 0, (ends.high or 0) - (ends.low or 0) + 1
    sources = depth_levels(plain, "source").toDF("s_value", "s_level")
    langs = depth_levels(plain, "lang").toDF("l_value", "l_level")
    leveled = plain.join(
        broadcast_if_small(sources), plain["source"].eqNullSafe(F.col("s_value"))
    ).join(broadcast_if_small(langs), plain["lang"].eqNullSafe(F.col("l_value")))
    by_id = (
        f"coalesce(cast((cast(doc as decimal(38, 0)) - {low}) * {LEVELS} div {span} as int), {LEVELS - 1})"
    )
    by_length = f"least(length(bin(size)), {LEVELS - 1})"
    levels = leveled.select(
        "row", "doc", "size", "crc", F.expr(f"array(s_level, l_level, {by_length}, {by_id})").alias("levels")
    )
    return levels.withColumn("hilbert", curve_index("levels", len(DIMENSIONS)))


def shard(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    keep: list[str] | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """(row, doc, size, crc, levels, hilbert, shard, slot): the documents cut into runs of the curve."""
    placed = curve(
        docs, doc=doc, text=text, source=source, lang=lang, keep=list(docs.columns if keep is None else keep)
    )
    order = ranked(
        placed,
        F.col("hilbert").asc(),
        F.col("crc").asc(),
        F.col("doc").asc_nulls_last(),
        F.col("size").asc(),
    )
    total = docs.count()
    small, longer = divmod(total, shards)
    # The first `longer` shards hold one row more.
    edge = longer * (small + 1)
    number = F.expr(
        f"if(rank < {edge}, rank div {small + 1}, {longer} + (rank - {edge}) div {max(small, 1)})"
    )
    slot = F.expr(f"if(rank < {edge}, rank % {small + 1}, (rank - {edge}) % {max(small, 1)})")
    return order.select(
        *[c for c in order.columns if c != "rank"],
        number.cast("int").alias("shard"),
        slot.cast("bigint").alias("slot"),
    )


def shard_table(sharded: DataFrame, key: str) -> DataFrame:
    return sharded.select(
        F.col(f"row.{key}").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; its files follow the curve, each a run of `rows_per_file` at most."""
    parts = max(1, int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (
        sharded.select("row.*", "shard", "slot")
        .repartitionByRange(parts, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )


def file_ranges(sharded: DataFrame) -> DataFrame:
    """Per shard and dimension the smallest and largest level: what a reader prunes by."""
    bounds = [
        f(F.col("levels")[i]).alias(f"{name}_{end}")
        for i, name in enumerate(DIMENSIONS)
        for end, f in (("low", F.min), ("high", F.max))
    ]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *bounds)
