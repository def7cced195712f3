"""Batch validation and the choice among sources."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions.scalars import expected_minutes
from ..schema import REQUIRED
from ..session import broadcast_if_small, pinned


def minimum_rows(minutes: int, min_ratio: float) -> int:
    """Candles a batch of that many minutes must hold at least."""
    return math.trunc(minutes * min_ratio)


def validate_batches(
    df: DataFrame,
    by: list[str],
    start: str,
    end: str,
    min_ratio: float = DEFAULTS.min_ratio,
    ts: str = "open_time",
) -> DataFrame:
    """One row per batch: its counts and whether it passes.

    ``by`` names a batch (for example source and window), ``start`` and ``end`` are
    columns with its bounds.  A batch without rows has no group and so never passes.
    Distinct times are counted by pre-aggregation on (batch, time), in one shuffle
    more than a plain count and without a task that holds a whole batch.
    """
    if not set(REQUIRED) - {"open_time"} | {ts} <= set(df.columns):
        missing = sorted((set(REQUIRED) - {"open_time"} | {ts}) - set(df.columns))
        raise ValueError(f"missing columns: {', '.join(missing)}")
    # Spark sorts NaN above every number; a missing price must not count as inverted
    inverted = (F.col("high") < F.col("low")) & ~F.isnan("low")
    per_time = df.groupBy(*by, start, end, ts).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.count_if(inverted).alias("_inverted"),
    )
    need = F.floor(expected_minutes(start, end) * F.lit(min_ratio)).cast("bigint")
    return (
        per_time.groupBy(*by, start, end)
        .agg(
            F.sum("_copies").alias("rows"),
            F.sum(F.col("_copies") - 1).alias("duplicate_times"),
            F.sum("_inverted").alias("inverted_rows"),
        )
        .withColumn("min_rows", need)
        .withColumn(
            "is_valid",
            (F.col("duplicate_times") == 0)
            & (F.col("inverted_rows") == 0)
            & (F.col("rows") >= F.col("min_rows")),
        )
    )


def validate_batch(
    df: DataFrame, start, end, min_ratio: float = DEFAULTS.min_ratio, ts: str = "open_time"
) -> bool:
    """Whether one batch passes for the given bounds (datetimes)."""
    if not set(REQUIRED) <= set(df.columns):
        return False
    bounded = df.withColumns({"_start": F.lit(start), "_end": F.lit(end)})
    verdict = validate_batches(bounded, [], "_start", "_end", min_ratio, ts).first()
    return bool(verdict and verdict["is_valid"])


def source_fallback(
    df: DataFrame,
    priority: list[str],
    by: list[str],
    start: str,
    end: str,
    min_ratio: float = DEFAULTS.min_ratio,
    ts: str = "open_time",
) -> DataFrame:
    """All rows of the first valid source per window; windows without one drop out.

    The winners (one row per window) are materialised, so that their counted size
    decides whether the candles must be shuffled to meet them.
    """
    verdicts = validate_batches(df, [*by, "source"], start, end, min_ratio, ts)
    rank = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col("source"))
    winners = (
        verdicts.where(F.col("is_valid") & (rank > 0))
        .groupBy(*by, start, end)
        .agg(F.min_by("source", rank).alias("source"))
    )
    return df.join(
        broadcast_if_small(pinned(winners)), [*by, start, end, "source"], "left_semi"
    )


def choose_source(
    batches: dict[str, DataFrame], start, end, min_ratio: float = DEFAULTS.min_ratio
) -> DataFrame:
    """First batch, in the order given, that passes; an error naming each cause if none does.

    A batch may be a DataFrame or a function returning one, whose failure counts as
    the cause for that source.
    """
    causes = {}
    for name, batch in batches.items():
        try:
            candles = batch() if callable(batch) else batch
            if validate_batch(candles, start, end, min_ratio):
                return candles
        except Exception as error:  # any failure of one source moves on to the next
            causes[name] = error
        else:
            causes[name] = "invalid data"
    listed = " | ".join(f"{name}: {cause}" for name, cause in causes.items())
    raise RuntimeError(f"All sources failed: {listed}")
