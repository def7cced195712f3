"""The feature and label marts, and their weekly increments."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CHUNK_ROWS, DEFAULTS
from ..operators.keys import cross_active_version
from ..schema import FEATURES, LABELS
from ..session import broadcast_if_small, pinned
from .features import FEATURE_HALO, feature_set
from .labels import label_set, with_future

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
KEY = ["series_id", "ts", "version_id"]


def _computed_at(as_of: datetime | None) -> Column:
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return stamp.alias("computed_at")


def features_mart(
    candles: DataFrame,
    versions: DataFrame,
    as_of: datetime | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Feature rows tagged with the active version, in table order."""
    features = feature_set(candles.where(F.col("ts").isNotNull()), chunk_rows)
    return cross_active_version(features, versions, strict).select(
        "series_id",
        "ts",
        "version_id",
        _computed_at(as_of),
        "raw_ingested_at",
        "source",
        *FEATURES,
        "symbol",
        "timeframe",
    )


def labels_mart(
    candles: DataFrame,
    versions: DataFrame,
    as_of: datetime | None = None,
    shock_threshold: float = DEFAULTS.shock_threshold,
    chunk_rows: int | None = CHUNK_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Label rows whose future is known, tagged with the active version."""
    labels = label_set(candles.where(F.col("ts").isNotNull()), shock_threshold, chunk_rows)
    return cross_active_version(with_future(labels), versions, strict).select(
        "series_id", "ts", "version_id", _computed_at(as_of), *LABELS, "symbol", "timeframe"
    )


def high_water(target: DataFrame, by: list[str] = (), ts: str = "ts") -> DataFrame:
    """Latest time per group, the epoch for a table without rows."""
    epoch = F.lit(EPOCH).cast(target.schema[ts].dataType)
    return target.groupBy(*by).agg(F.coalesce(F.max(ts), epoch).alias("mark"))


def checkpoint_row(
    target: DataFrame, inserted: DataFrame, by: list[str], ts: str = "ts"
) -> DataFrame:
    """Latest time of the target and number of rows just inserted, per group."""
    marks = target.groupBy(*by).agg(F.max(ts).alias("last_ts"))
    counts = inserted.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_inserted"))
    return marks.join(counts, list(by), "left").select(
        *by,
        "last_ts",
        F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"),
        F.lit("ok").alias("status"),
    )


def last_checkpoint(log: DataFrame) -> DataFrame:
    """Latest successfully processed time per version."""
    return log.where(F.col("status") == "ok").groupBy("version_id").agg(
        F.max("last_ts").alias("last_ts")
    )


def with_marks(candles: DataFrame, marks) -> DataFrame:
    """Add ``_mark``: one time for all series, or a table (series_id, mark)."""
    if not isinstance(marks, DataFrame):
        return candles.withColumn("_mark", F.lit(marks if marks is not None else EPOCH))
    named = marks.select(F.col("series_id").alias("_series"), F.col("mark").alias("_mark"))
    # a series without a name has a mark, too
    same = F.col("series_id").eqNullSafe(F.col("_series"))
    joined = candles.join(broadcast_if_small(named), same, "left").drop("_series")
    epoch = F.lit(EPOCH).cast(candles.schema["ts"].dataType)
    return joined.withColumn("_mark", F.coalesce("_mark", epoch))


def after_mark(candles: DataFrame, marks) -> DataFrame:
    """Rows newer than the mark of their series."""
    return with_marks(candles, marks).where(F.col("ts") > F.col("_mark")).drop("_mark")


def lookback_days(candles: DataFrame, marks, rows: int) -> DataFrame:
    """First day each series with new rows must be read from: (series_id, _from).

    Counted on (series, day), so that the last ``rows`` rows before the mark are
    covered whatever gaps the series has; the days of a series bound its group.
    """
    later = (
        Window.partitionBy("series_id")
        .orderBy(F.col("_day").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    by_series = Window.partitionBy("series_id")
    seen = F.col("ts") <= F.col("_mark")
    days = (
        with_marks(candles.select("series_id", "ts"), marks)
        .groupBy("series_id", F.to_date("ts").alias("_day"))
        .agg(F.count_if(seen).alias("_old"), F.count_if(~seen).alias("_new"))
        .withColumn("_later", F.coalesce(F.sum("_old").over(later), F.lit(0)))
        .withColumn("_any_new", F.max("_new").over(by_series))
    )
    return (
        days.where((F.col("_any_new") > 0) & (F.col("_later") < rows))
        .groupBy("series_id")
        .agg(F.min("_day").alias("_from"))
    )


def with_lookback(candles: DataFrame, marks, rows: int) -> DataFrame:
    """New rows plus at least ``rows`` earlier rows of the same series."""
    start = lookback_days(candles, marks, rows).withColumnRenamed("series_id", "_series")
    wanted = F.col("series_id").eqNullSafe(F.col("_series")) & (F.to_date("ts") >= F.col("_from"))
    return candles.join(broadcast_if_small(pinned(start)), wanted).drop("_series", "_from")


def feature_increment(
    candles: DataFrame,
    versions: DataFrame,
    marks,
    as_of: datetime | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Features of the rows after the mark, equal to those of a full run.

    The look-back counts rows: a fixed span of minutes would come short wherever
    candles are missing.
    """
    if marks is None:
        return features_mart(candles, versions, as_of, chunk_rows)
    recent = with_lookback(candles, marks, FEATURE_HALO.back)
    return after_mark(features_mart(recent, versions, as_of, chunk_rows), marks)


def label_increment(
    candles: DataFrame,
    versions: DataFrame,
    marks,
    as_of: datetime | None = None,
    shock_threshold: float = DEFAULTS.shock_threshold,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Labels of the rows after the mark; labels look ahead only, so no look-back."""
    fresh = candles if marks is None else after_mark(candles, marks)
    return labels_mart(fresh, versions, as_of, shock_threshold, chunk_rows)
