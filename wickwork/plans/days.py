"""What a day-partitioned table holds per series and day, kept beside it.

Marks, look-backs and inserted rows come from this small table, so an increment never
groups the large one.  A digest of the rows tells which days have changed since something
was made of them.  A write names its days first; if it breaks off, the next reader
counts just these days again, so the counts never fall behind the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, pinned
from ..sources import tables
from ..sources.tables import DAY


@dataclass(frozen=True)
class DayIndex:
    """(keys, ts_date, rows, last_ts, digest) of the table at ``path``.

    The digest adds up hashes of all columns but the folders', so it merges by addition and
    does not depend on the order of rows or on files.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ("series_id",)

    @property
    def _counts(self) -> str:
        return f"{self.path}_days"

    @property
    def _pending(self) -> str:
        return f"{self.path}_days_pending"

    def read(self) -> DataFrame | None:
        """The counts as of now, None while the table has no data."""
        if not tables.table_exists(self.spark, self.path):
            return None
        known = tables.table_exists(self.spark, self._counts)
        if not known or "digest" not in self.spark.read.parquet(self._counts).columns:
            self._write(self._count(self.spark.read.parquet(self.path)))
        elif tables.table_exists(self.spark, self._pending):
            self._recount([r[0] for r in self.spark.read.parquet(self._pending).collect()])
        return pinned(self.spark.read.parquet(self._counts))

    def update(self, days: list[date], write: Callable[[], None]) -> None:
        """Run a write that changes no other days than ``days``, then count them again.

        Counts left over by a broken write must have been read before.
        """
        if days:
            rows = self.spark.createDataFrame([(d,) for d in days], "day date")
            tables.replace_table(rows.coalesce(1), self._pending)
        write()
        if days and tables.table_exists(self.spark, self.path):
            if tables.table_exists(self.spark, self._counts):
                self._recount(days)
            else:
                self.read()
                tables.remove(self.spark, self._pending)

    def _count(self, rows: DataFrame) -> DataFrame:
        content = sorted(set(rows.columns) - {DAY, tables.VERSION})
        return rows.groupBy(*self.keys, DAY).agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("ts").alias("last_ts"),
            F.sum(F.xxhash64(*content).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest"),
        )

    def _write(self, counts: DataFrame) -> None:
        (
            counts.hint("rebalance", F.col(DAY))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(self._counts)
        )

    def _recount(self, days: list[date]) -> None:
        # the list of days is bounded by the calendar
        counts = pinned(self._count(self.spark.read.parquet(self.path).where(F.col(DAY).isin(days))))
        self._write(counts)
        present = {r[0] for r in counts.select(DAY).distinct().collect()}
        for day in sorted(set(days) - present):
            tables.remove(self.spark, f"{self._counts}/{DAY}={day:%Y-%m-%d}")
        tables.remove(self.spark, self._pending)


def marks_of(done: DataFrame) -> DataFrame:
    """Latest time per series of a mart, from its counts."""
    return done.groupBy("series_id").agg(F.max("last_ts").alias("mark"))


def days_to_read(stored: DataFrame, done: DataFrame, back: int, ahead: int) -> DataFrame:
    """The (series_id, ts_date) of silver that an increment needs.

    ``stored`` counts silver, ``done`` the mart.  A series is read if more than ``ahead``
    rows lie after its mark; rows on the day of the mark count as far as the mart does
    not have them.  Then it needs the day of the mark, all later days, and as many
    earlier ones as hold ``back`` rows, gaps or not.  A series without a mark is read whole.
    """
    marks = marks_of(done).select(
        F.col("series_id").alias("_series"), F.to_date("mark").alias("_mark_day")
    )
    have = done.select(
        F.col("series_id").alias("_has"), F.col(DAY).alias("_has_day"), F.col("rows").alias("_done")
    )
    series = Window.partitionBy("series_id")
    nearer = series.orderBy(F.col(DAY).desc()).rowsBetween(Window.unboundedPreceding, -1)
    after, day = F.col(DAY) >= F.col("_mark_day"), F.col(DAY)
    return (
        stored.join(marks, F.col("series_id").eqNullSafe(F.col("_series")), "left")
        .join(
            have,
            F.col("series_id").eqNullSafe(F.col("_has"))
            & (day == F.col("_has_day"))
            & (day == F.col("_mark_day")),
            "left",
        )
        .withColumn(
            "_new",
            F.when(F.col("_mark_day").isNull() | after, F.col("rows") - F.coalesce("_done", F.lit(0))),
        )
        .withColumn("_fresh", F.sum("_new").over(series))
        .withColumn("_between", F.sum(F.when(~after, F.col("rows"))).over(nearer))
        .where(
            (F.col("_fresh") > ahead)
            & (
                F.col("_mark_day").isNull()
                | after
                | (F.coalesce("_between", F.lit(0)) < F.lit(back))
            )
        )
        .select("series_id", DAY)
    )


def read_days(silver: DataFrame, needed: DataFrame) -> tuple[DataFrame, list[date]]:
    """Silver rows of the needed days per series, and all days in question.

    The days, bounded by the calendar, prune folders when the plan is made.
    """
    needed = pinned(needed)
    days = sorted(r[0] for r in needed.select(DAY).distinct().collect())
    first = needed.groupBy(F.col("series_id").alias("_series")).agg(F.min(DAY).alias("_first"))
    wanted = F.col("series_id").eqNullSafe(F.col("_series")) & (F.col(DAY) >= F.col("_first"))
    rows = silver.where(F.col(DAY).isin(days)).join(broadcast_if_small(pinned(first)), wanted)
    return rows.drop("_series", "_first"), days
