"""Marts that follow every change of silver, late and corrected candles included, in windows.

Beside a mart stands what it was made of: rows and digest of silver per series and day. Days
that differ now are changed; a changed candle reaches as many rows ahead and back as the
frames do, which the counts turn into days. Only these dirty days are made anew and replaced,
series by series; all others keep their files.

The dirty days are written down first and crossed out window by window, each window a run of
days with a bounded number of rows. This list is the ledger of a refresh: one that was killed
goes on where it stood, and windows that are done are not read again. Small windows are made
a few at a time, each by a plan of its own, while earlier ones are written, one by one and in
order; their days are counted together.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.chunks import Halo
from ..session import broadcast_if_small, pinned
from ..sources import tables
from ..sources.tables import DAY
from .days import DayIndex

ONE_DAY = ["series_id", DAY]

# Windows that are made while others are written: so many, of so many rows in all.
AT_ONCE, ROWS_AT_ONCE = 4, 2_000_000


def _reach(days: DataFrame, rows: str, marked: str, back: int, ahead: int) -> DataFrame:
    """Marked days, days that begin within `back` rows behind one, or end within `ahead` before one.

    ``days`` has one row per series and day; the days of a series bound its window.
    """
    order = Window.partitionBy("series_id").orderBy(DAY)
    upto = F.sum(rows).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    summed = days.withColumn("_upto", upto)
    out = summed.withColumns({
        "_last": F.last(F.when(F.col(marked), F.col("_upto")), ignorenulls=True).over(earlier),
        "_next": F.first(F.when(F.col(marked), F.col("_upto") - F.col(rows)), ignorenulls=True).over(later),
    })
    near = (F.col("_upto") - F.col(rows) - F.col("_last") < back) | (F.col("_next") - F.col("_upto") < ahead)
    return out.where(F.col(marked) | F.coalesce(near, F.lit(False)))


def dirty_days(stored: DataFrame, made_of: DataFrame | None, mart: DataFrame | None, halo: Halo) -> DataFrame:
    """(series_id, ts_date, rows, changed): days of a mart that silver no longer gives as they are.

    ``stored`` counts silver now, ``made_of`` as it was when the mart was made, ``mart`` the
    mart itself. Rows are those that both states have, so the reach of a change is no shorter
    than in either.
    """
    none = {"new": "bigint", "new_digest": "decimal(38,0)", "old": "bigint", "old_digest": "decimal(38,0)", "own": "bigint"}
    parts = [(stored, {"new": "rows", "new_digest": "digest"})]
    parts += [] if made_of is None else [(made_of, {"old": "rows", "old_digest": "digest"})]
    parts += [] if mart is None else [(mart, {"own": "rows"})]
    frames = [
        df.where(F.col(DAY).isNotNull()).select(
            *ONE_DAY, *[F.col(names[c]).alias(c) if c in names else F.lit(None).cast(k).alias(c) for c, k in none.items()]
        )
        for df, names in parts
    ]
    both = frames[0]
    for frame in frames[1:]:
        both = both.unionByName(frame)
    days = both.groupBy(*ONE_DAY).agg(*[F.max(c).alias(c) for c in none])
    same = F.col("new").eqNullSafe(F.col("old")) & F.col("new_digest").eqNullSafe(F.col("old_digest"))
    zero = F.lit(0).cast("bigint")
    days = days.withColumns({
        "changed": ~same | F.col("new").isNull(),
        "rows": F.least(F.coalesce("new", zero), F.coalesce("old", zero)),
        "new": F.coalesce("new", zero),
    })
    # forward frames see changes behind them, look-backs those in front
    return _reach(days, "rows", "changed", halo.back, halo.ahead).select(*ONE_DAY, F.col("new").alias("rows"), "changed")


def days_needed(stored: DataFrame, dirty: DataFrame, halo: Halo) -> DataFrame:
    """(series_id, ts_date, rows) of silver that the dirty days' frames touch.

    If ``stored`` lacks days that none of the frames touch, it may be more days, never fewer.
    """
    marks = dirty.select(*ONE_DAY, F.lit(0).cast("bigint").alias("rows"), F.lit(True).alias("wanted"))
    own = stored.where(F.col(DAY).isNotNull()).select(*ONE_DAY, "rows", F.lit(False).alias("wanted"))
    days = own.unionByName(marks).groupBy(*ONE_DAY).agg(F.sum("rows").alias("rows"), F.max("wanted").alias("wanted"))
    # a row needs what lies before it: the roles of both directions are exchanged
    return _reach(days, "rows", "wanted", halo.ahead, halo.back).where("rows > 0").select(*ONE_DAY, "rows")


def _named(days: DataFrame) -> DataFrame:
    return days.select(F.col("series_id").alias("_series"), F.col(DAY).alias("_on"))


def _on(day: Column) -> Column:
    return F.col("series_id").eqNullSafe(F.col("_series")) & (day == F.col("_on"))


@dataclass(frozen=True)
class MartState:
    """What one version of a mart was made of, and its days that are still to be made."""

    spark: SparkSession
    path: str
    version: str

    def _folder(self, kind: str) -> str:
        return f"{self.path}_{kind}/{tables.VERSION}={tables.version_folder(self.version)}"

    @property
    def rows(self) -> str:
        return f"{self.path}/{tables.VERSION}={tables.version_folder(self.version)}"

    def _read(self, kind: str) -> DataFrame | None:
        path = self._folder(kind)
        return pinned(self.spark.read.parquet(path)) if tables.table_exists(self.spark, path) else None

    def _write(self, df: DataFrame, kind: str) -> None:
        (
            df.hint("rebalance", F.col(DAY))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(self._folder(kind))
        )

    def _drop(self, kind: str, days: list[date]) -> None:
        for day in days:
            tables.remove(self.spark, f"{self._folder(kind)}/{DAY}={day:%Y-%m-%d}")

    def plan(self, stored: DataFrame, mart: DataFrame | None, halo: Halo, everything: bool = False) -> DataFrame:
        """Note what is dirty, together with what an earlier run has left; (series_id, ts_date, rows).

        ``everything`` begins a full refresh, or goes on with one that was broken off.
        """
        going_on = tables.table_exists(self.spark, self._folder("refresh"))
        made_of = None if everything and not going_on else self._read("sources")
        found = pinned(dirty_days(stored, made_of, mart, halo))
        left = self._read("dirty")
        if left is not None and not (everything and not going_on):
            noted = left.select(*ONE_DAY, "rows", F.lit(False).alias("changed"))
            found = pinned(found.unionByName(noted).groupBy(*ONE_DAY).agg(F.max("rows").alias("rows"), F.max("changed").alias("changed")))
        if found.take(1):
            self._write(found.select(*ONE_DAY, "rows"), "dirty")
        if everything and not going_on:
            tables.replace_table(self.spark.range(1), self._folder("refresh"))
        # From here on the list holds all that is dirty, so the sources may move on.
        changed = [r[0] for r in found.where("changed").select(DAY).distinct().collect()]
        if changed:
            now = pinned(stored.where(F.col(DAY).isin(changed)).select(*ONE_DAY, "rows", "digest"))
            present = {r[0] for r in now.select(DAY).distinct().collect()}
            if present:
                self._write(now, "sources")
            self._drop("sources", sorted(set(changed) - present))
        return found

    def done(self, days: list[date]) -> None:
        self._drop("dirty", days)

    def finished(self) -> None:
        tables.remove(self.spark, self._folder("refresh"))


def windows(dirty: DataFrame, most_rows: int) -> list[tuple[list[date], int]]:
    """The dirty days in order, cut into runs of at most so many rows or one day, and their rows."""
    out: list[tuple[list[date], int]] = []
    # one row per day of the calendar
    for day, rows in sorted(dirty.groupBy(DAY).agg(F.sum("rows")).collect()):
        if out and out[-1][1] + rows <= most_rows:
            out[-1] = [*out[-1][0], day], out[-1][1] + rows
        else:
            out.append(([day], rows))
    return out


def together(cut: list[tuple[list[date], int]]) -> list[list[list[date]]]:
    """Windows in order, as groups that are small enough to be made side by side."""
    out: list[list[list[date]]] = []
    held = 0
    for days, rows in cut:
        if not out or held + rows > ROWS_AT_ONCE or len(out[-1]) == 2 * AT_ONCE:
            out.append([])
            held = 0
        out[-1].append(days)
        held += rows
    return out


def bring_up_to_date(
    silver_path: str,
    index: DayIndex,
    state: MartState,
    stored: DataFrame,
    halo: Halo,
    make: Callable[[DataFrame], DataFrame],
    everything: bool,
    window_rows: int,
) -> int:
    """Make the dirty days of a version of a mart anew; returns the number of windows.

    ``make`` gives mart rows for candles. Rows of dirty days are replaced per series.
    """
    spark = state.spark
    counts = index.read()
    own = None if counts is None else counts.where(F.col("version_id") == state.version)
    dirty = state.plan(stored, own, halo, everything)
    cut = windows(dirty, window_rows)
    for group in together(cut):
        listed = [day for days in group for day in days]
        near = pinned(days_needed(stored, dirty.where(F.col(DAY).isin(listed)), halo))
        silver = spark.read.parquet(silver_path)
        # Listed before the group writes: a window reads its own days only, which no other replaces.
        old = spark.read.parquet(state.rows) if tables.table_exists(spark, state.rows) else None

        def made(days, near=near, silver=silver, old=old) -> DataFrame:
            wanted = dirty.where(F.col(DAY).isin(days)).select(*ONE_DAY)
            needed = pinned(days_needed(near, wanted, halo))
            read = sorted(r[0] for r in needed.select(DAY).distinct().collect())
            candles = silver.where(F.col(DAY).isin(read))
            candles = candles.join(broadcast_if_small(_named(needed)), _on(F.col(DAY)), "left_semi").drop(DAY)
            marks = broadcast_if_small(_named(wanted))
            rows = make(candles).join(marks, _on(F.to_date("ts")), "left_semi")
            if old is not None:
                kept = old.where(F.col(DAY).isin(days)).join(marks, _on(F.col(DAY)), "left_anti")
                rows = rows.unionByName(kept.select(*rows.columns))
            return pinned(rows)

        def write(group=group, made=made) -> None:
            with ThreadPoolExecutor(AT_ONCE) as pool:
                found = [pool.submit(made, days) for days in group]
                try:
                    for days, rows in zip(group, found):
                        rows = rows.result()
                        present = set(tables.days_of(rows))
                        tables.overwrite_days(rows, state.rows)
                        for day in set(days) - present:
                            tables.remove(spark, f"{state.rows}/{DAY}={day:%Y-%m-%d}")
                        state.done(days)
                finally:
                    for rest in found:
                        rest.cancel()

        # One that is broken off is counted again by the next reader, so its windows may be done before.
        index.update(listed, write)
    state.finished()
    return len(cut)
