"""Filters and projections between the candle layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import previous_full_week
from ..schema import INTERVAL, NUMBERS, SERIES_BY_SYMBOL, SILVER_COLUMNS, series_of
from .dedupe import keep_latest

_PRICE_NAMES = {c: f"{c}_price" for c in NUMBERS if c != "volume"} | {"volume": "volume"}


def silver_filter(bronze: DataFrame) -> DataFrame:
    """Rows with a time, a close and high >= low; NULL and NaN prices fail the comparison."""
    ordered = (F.col("high") >= F.col("low")) & ~F.isnan("high")
    return bronze.where(F.col("open_time").isNotNull() & F.col("close").isNotNull() & ordered)


def dedupe_latest(bronze: DataFrame, key: str = "series_id") -> DataFrame:
    """Latest extraction per candle; ties are settled by the remaining columns."""
    rest = [c for c in ("source", "symbol", *NUMBERS, "close_time") if c in bronze.columns]
    return keep_latest(bronze, [key, "open_time"], "extracted_at", rest)


def latest_silver(rows: DataFrame) -> DataFrame:
    """``dedupe_latest`` for rows in silver layout: same rule, same ties."""
    rest = ["source", "symbol", *_PRICE_NAMES.values()]
    return keep_latest(rows, ["series_id", "ts"], "ingested_at", rest)


def with_series(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn("series_id", series_of("symbol", mapping))


def silver(bronze: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Clean candles: filtered, one per (series, open time), typed and renamed."""
    mapping = SERIES_BY_SYMBOL if mapping is None else mapping
    latest = dedupe_latest(with_series(silver_filter(bronze), mapping))
    return latest.select(
        "series_id",
        "symbol",
        F.col("open_time").alias("ts"),
        F.lit(INTERVAL).alias("timeframe"),
        *[F.col(c).cast("double").alias(name) for c, name in _PRICE_NAMES.items()],
        "source",
        F.col("extracted_at").alias("ingested_at"),
        F.lit(True).alias("is_closed"),
    ).select(*SILVER_COLUMNS)


def raw_projection(bronze: DataFrame) -> DataFrame:
    """Bronze candle in the older raw-table layout, every candle marked closed."""
    return bronze.select(
        "symbol",
        F.col("open_time").alias("ts"),
        F.col("interval").alias("timeframe"),
        *[F.col(c).alias(name) for c, name in _PRICE_NAMES.items()],
        "source",
        F.col("extracted_at").alias("ingested_at"),
        F.lit(True).alias("is_closed"),
    )


def in_window(df: DataFrame, start, end, ts: str = "open_time") -> DataFrame:
    """Half-open time range: start included, end excluded."""
    lower, upper = (x if isinstance(x, Column) else F.lit(x) for x in (start, end))
    return df.where((F.col(ts) >= lower) & (F.col(ts) < upper))


def in_previous_week(df: DataFrame, reference, ts: str = "open_time") -> DataFrame:
    reference = reference if isinstance(reference, Column) else F.lit(reference)
    return in_window(df, *previous_full_week(reference), ts)


def before_cutoff(df: DataFrame, cutoff, ts: str = "ts") -> DataFrame:
    return df.where(F.col(ts) < (cutoff if isinstance(cutoff, Column) else F.lit(cutoff)))


def closed_candles(raw: DataFrame, symbol: str | None = None, timeframe: str = INTERVAL) -> DataFrame:
    chosen = (F.col("timeframe") == timeframe) & F.col("is_closed")
    if symbol is not None:
        chosen &= F.col("symbol") == symbol
    return raw.where(chosen)


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def working_copy(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The table as it is, as a lazy copy; write it to make the copy durable."""
    return df.select(*(columns or df.columns))


def backfill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULLs by a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def evolve_schema(old: DataFrame, new: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Rows of an older layout and a newer one together; new columns get defaults."""
    return backfill_defaults(old.unionByName(new, allowMissingColumns=True), defaults)
