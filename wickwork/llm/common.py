"""Helpers shared by the operators: rows through Python, stored tables, ranks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import broadcast_if_small, pinned, scratch_folder
from .words import slices

#: Characters between words: space, tab, newline, vertical tab, form feed, return.
BLANKS = "\\x20\\x09-\\x0D"


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))


def annotate(
    docs: DataFrame,
    text: str,
    fields: Sequence[tuple[str, str]],
    work: Callable[[pa.Array], Sequence],
    keep: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per input row: the kept columns as struct `row`, and new columns.

    Input columns sit inside `row`, so no name of theirs can clash with a new one. `work`
    gets the texts of a slice (of at most `rows`) and returns one Arrow array or list per field.
    """
    bounded_batches(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)
    columns = [F.struct(*[docs[c] for c in keep]).alias("row")]
    inside = keep.index(text) if text in keep else None
    if inside is None:
        columns.append(docs[text].cast("string").alias("text"))
    packed = docs.select(*columns)
    added = [field(n, k) for n, k in fields]
    kinds = [to_arrow_type(f.dataType) for f in added]
    names = ["row", *[f.name for f in added]]

    def texts(batch: pa.RecordBatch) -> pa.Array:
        if inside is None:
            return batch.column("text")
        return pc.struct_field(batch.column("row"), [inside])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, texts, rows=rows):
            made = [as_array(v, k) for v, k in zip(work(texts(batch)), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], names=names)

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *added]))


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


#: Rows and bytes that go to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: workers hold a few of them, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """Computed once, into the folder that all executors share; dropped with its last user."""
    bounded_batches(df.sparkSession)
    return pinned(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like `stored`, as compressed Parquet, for rows with texts or many rows."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket(column: Column | str, parts: int, wanted: int) -> Column:
    """True for ids whose crc32, as text, leaves `wanted` modulo `parts`; a null id counts as ''."""
    text = F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column, F.lit(""))
    return F.crc32(text.cast("binary")) % parts == wanted


def ranked(df: DataFrame, *order: Column, measures: dict[str, Column] | None = None) -> DataFrame:
    """Add `rank` (from 0, by `order`) and, per measure m, the sum `m_before` of earlier rows.

    A range sort, then offsets of the sorted parts; no window spans more than one part, and
    the only single task adds up one row per part. Each row stands for itself: give a total
    order, or rows that tie must be the same.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    measures = measures or {}
    cut = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number of a row in its part, and the part, as they stood when the part was sorted.
    numbered = written(
        cut.select("*", F.monotonically_increasing_id().alias("_at")), "ranked"
    ).select("*", F.shiftright("_at", 33).cast("int").alias("_part"))
    sums = {m: F.sum(c).alias(f"_sum_{m}") for m, c in measures.items()}
    totals = numbered.groupBy("_part").agg(F.count("*").alias("_rows"), *sums.values())
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
        *[
            F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_base_{m}")
            for m in measures
        ],
    )
    # One row per sorted part: `parts` rows at most.
    out = numbered.join(F.broadcast(offsets), "_part")
    low = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return out.select(
        *df.columns,
        (F.col("_first") + low).alias("rank"),
        *[
            (F.col(f"_base_{m}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{m}_before")
            for m, c in measures.items()
        ],
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over `links` (a, b); linked nodes but the smallest.

    Hash-to-min rounds with a written table each; a node sends the smallest node it knows to
    all others it knows, so the rounds grow with the logarithm of the longest path. They end
    as soon as every node but the smallest ones knows one smaller node, which is such a one. A
    frequent smallest node is met by partial aggregation, never gathered.
    """
    edges = stored(
        links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    while _unsettled(edges):
        # Large star: larger neighbours of a node move to its smallest neighbour (or itself).
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        )
        # Small star: smaller neighbours of a node, and the node, move to the smallest.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(least, "v")
            .select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small)
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has two smaller neighbours, or a smaller and a larger one."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(
        edges.select("u", F.lit(0), F.lit(1))
    )
    met = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return not met.where("low > 1 OR low + high > 1").isEmpty()


#: Keys broadcast at most, to find the rows that have them or lack them.
KNOWN_KEYS = 500_000


def of_keys(rows: DataFrame, keys: DataFrame, name: str, inside: bool = True) -> DataFrame:
    """Rows whose `name` is among the keys (a written table), or not; few keys spare a shuffle."""
    return rows.join(broadcast_if_small(keys, KNOWN_KEYS), name, "left_semi" if inside else "left_anti")


#: Keys of more than this share of all rows meet them by broadcast.
HOT_SHARE = 1000


def hot_join(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """`rows` inner joined with `table`, in which every key stands once, spread over all tasks.

    `count` says how many of the `total` rows have a key. At most `HOT_SHARE` keys have that
    share of the rows or more: these are broadcast, the others are joined by a shuffle, in
    which no key is large. A row comes out of one of the two joins, once. Both arguments are
    read twice, so pass written tables.
    """
    hot = F.col(count) * HOT_SHARE >= total
    found = table.where(hot)
    rest = rows.join(F.broadcast(found.select(key)), key, "left_anti").join(table.where(~hot), key)
    return rows.join(F.broadcast(found), key).unionByName(rest)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over values[i : i + width] for every i with a full window."""
    out, done = values, 1
    while 2 * done <= width:
        out = pick(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def within(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in a sorted array, -1 where it is missing."""
    if not len(sorted_values):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(sorted_values, wanted)
    at[at == len(sorted_values)] = 0
    return np.where(sorted_values[at] == wanted, at, -1)
