"""Bounded row windows over long series, in parallel.

A window ordered by time alone runs in one task per series.  Every frame used
here is bounded in rows, so a series can be cut into chunks of consecutive days
as long as each chunk also sees the rows its frames reach back (or ahead) to.

The cut is planned on one row per (series, day): with ``before`` the number of
rows ahead of a day, the day belongs to chunk ``floor(before / C)`` and is copied
to every other chunk whose frames may touch one of its rows.  No row number over
the data is needed, and the data itself is shuffled once, on (series, chunk), or twice
where the map of the cut series is too large to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import broadcast_if_small, pinned

CHUNK = "_chunk"
OWN = "_own_chunk"
DAY = "_day"

# Window work is heavy per byte, so tasks are sized by rows: about a minute each.
TASK_ROWS = 2_000_000
MOST_TASKS = 200_000


@dataclass(frozen=True)
class Halo:
    """Rows a computation needs before and after the row it computes."""

    back: int = 0
    ahead: int = 0

    def __add__(self, other: "Halo") -> "Halo":
        """Halo of a computation fed by another one."""
        return Halo(self.back + other.back, self.ahead + other.ahead)

    def __or__(self, other: "Halo") -> "Halo":
        """Halo of two computations side by side."""
        return Halo(max(self.back, other.back), max(self.ahead, other.ahead))


def plan_chunks(
    df: DataFrame, halo: Halo, chunk_rows: int, series: str = "series_id", ts: str = "ts"
) -> DataFrame:
    """One row per (series, day): its own chunk and the chunks it is copied to.

    The running sum is per series over calendar days, so a group has as many rows
    as the history has days, however many candles a series holds.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    c = F.lit(chunk_rows).cast("bigint")
    by_series = Window.partitionBy(series)
    earlier = by_series.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)

    def chunk_of(position):
        return F.floor(position / c)

    days = (
        df.select(series, F.to_date(ts).alias(DAY))
        .groupBy(series, DAY)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_widest", F.max("_n").over(by_series))
        .withColumn(OWN, chunk_of(F.col("_before")))
        .withColumn("_final", F.max(OWN).over(by_series))
    )
    # a chunk starts at or after c*C, so c*C - back bounds what it reaches back to;
    # its last day starts before (c+1)*C and ends at most `widest` rows later
    first = F.col(OWN)
    if halo.ahead:
        reach = F.col("_before") - F.lit(halo.ahead) - F.col("_widest")
        first = F.greatest(F.lit(0).cast("bigint"), F.least(F.col(OWN), chunk_of(reach)))
    last = F.col(OWN)
    if halo.back:
        reach = F.col("_before") + F.col("_n") - 1 + F.lit(halo.back)
        last = F.least(F.col("_final"), chunk_of(reach))
    return days.select(
        series, DAY, "_n", "_final", OWN, F.sequence(first, last).alias("_chunks")
    )


def task_count(rows: int, groups: int, parallelism: int) -> int:
    """Shuffle partitions for window groups: by rows, but enough to keep all cores busy."""
    spread = min(4 * groups, 4 * parallelism)
    return max(1, min(MOST_TASKS, max(-(-rows // TASK_ROWS), spread)))


def split_with_halo(
    df: DataFrame, halo: Halo, chunk_rows: int | None, series: str = "series_id", ts: str = "ts"
) -> DataFrame:
    """Add the chunk columns, copying the halo rows, arranged for the windows.

    ``chunk_rows=None`` keeps each series whole.  The plan table is materialised
    first; its measured size decides between a broadcast and a shuffled join, its row
    counts size the one shuffle of the data, and if no series needs a second chunk
    nothing is copied.
    """
    whole = df.withColumns({CHUNK: F.lit(0).cast("bigint"), OWN: F.lit(0).cast("bigint")})
    if chunk_rows is None:
        return whole
    plan = pinned(plan_chunks(df, halo, chunk_rows, series, ts))
    is_cut = F.col("_final") > 0
    days, cut_days, rows, groups = plan.agg(
        F.count(F.lit(1)),
        F.count_if(is_cut),
        F.sum(F.col("_n") * F.size("_chunks")),
        F.approx_count_distinct(F.hash(series, OWN)),
    ).first()
    if not days:
        return whole
    tasks = task_count(rows, groups, df.sparkSession.sparkContext.defaultParallelism)
    if not cut_days:
        return whole.repartition(tasks, series)
    # only series with several chunks are in the map; the others stay in chunk 0
    cut = plan.where(is_cut).select(
        F.col(series).alias("_series"), F.col(DAY).alias("_cut_day"), OWN, "_chunks"
    )
    zero = F.lit(0).cast("bigint")
    # a series without a name is a series, too
    same = F.col(series).eqNullSafe(F.col("_series")) & (F.to_date(ts) == F.col("_cut_day"))
    return (
        df.join(broadcast_if_small(cut, rows=cut_days), same, "left")
        .drop("_series", "_cut_day")
        .withColumns(
            {
                OWN: F.coalesce(OWN, zero),
                CHUNK: F.explode(F.coalesce("_chunks", F.array(zero))),
            }
        )
        .drop("_chunks")
        .repartition(tasks, series, CHUNK)
    )


def chunk_window(series: str = "series_id", ts: str = "ts") -> WindowSpec:
    return Window.partitionBy(series, CHUNK).orderBy(ts)


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the copies and the helper columns."""
    return df.where(F.col(CHUNK) == F.col(OWN)).drop(CHUNK, OWN)
