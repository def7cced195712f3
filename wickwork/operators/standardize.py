"""Raw vendor candles to the common candle schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.series import ColumnOrName, _col
from ..schema import BRONZE, INTERVAL, NUMBERS, RAW_CANDLE
from .dedupe import keep_first


def known_number(x: ColumnOrName) -> Column:
    """NaN means a missing value, so it becomes NULL."""
    return F.when(~F.isnan(_col(x)), _col(x))


def coerce_numeric(x: ColumnOrName) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    text = _col(x).cast("string")
    # Spark also reads "1.5d" and "1.5f" as numbers, which they are not in a payload
    return F.when(
        ~text.rlike(r"[0-9.][dDfF]\s*$"), known_number(text.try_cast("double"))
    )


def parse_mixed_ts(x: ColumnOrName) -> Column:
    """Epoch milliseconds or ISO text to a UTC timestamp; unreadable text is NULL."""
    text = F.trim(_col(x).cast("string"))
    millis = text.try_cast("bigint")
    return F.when(millis.isNotNull(), F.timestamp_millis(millis)).otherwise(
        text.try_cast("timestamp")
    )


def _parsed(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp")
    if isinstance(kind, T.IntegralType):
        return F.timestamp_millis(name)
    if isinstance(kind, T.NumericType):
        return F.timestamp_micros((F.col(name) * 1000).cast("bigint"))
    return parse_mixed_ts(name)


def _number(df: DataFrame, name: str) -> Column:
    is_double = isinstance(df.schema[name].dataType, T.DoubleType)
    return known_number(name) if is_double else coerce_numeric(name)


def _as_column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def standardize(
    raw: DataFrame,
    symbol: Column | str,
    source: Column | str,
    extracted_at: Column,
    interval: Column | str = INTERVAL,
) -> DataFrame:
    """The 11 bronze columns, one row per (source, symbol, open time).

    ``raw`` holds open_time, close_time and the five numbers as text, numbers or
    timestamps; text is taken as the constant name, a Column is evaluated per row.
    Of rows for one minute the one with the fewest missing values stays.
    """
    candles = raw.select(
        *[_parsed(raw, c).alias(c) for c in ("open_time", "close_time")],
        *[_number(raw, c).alias(c) for c in NUMBERS],
        _as_column(symbol).alias("symbol"),
        _as_column(interval).alias("interval"),
        _as_column(source).alias("source"),
        extracted_at.cast("timestamp").alias("extracted_at"),
    ).select(*BRONZE.names)
    values = [F.col(c) for c in RAW_CANDLE[1:]]
    missing = reduce(lambda a, b: a + b, [v.isNull().cast("int") for v in values])
    return keep_first(candles, ["source", "symbol", "open_time"], [missing, *values])


def unreadable_times(raw: DataFrame, columns: tuple[str, ...] = ("open_time", "close_time")):
    """Rows whose time text cannot be read; a batch with any is not valid."""
    bad = [F.col(c).isNotNull() & _parsed(raw, c).isNull() for c in columns]
    return raw.where(bad[0] | bad[1] if len(bad) > 1 else bad[0])
