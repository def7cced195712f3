"""Landed vendor payloads to raw candles.

Each payload is one page of a vendor's answer: a JSON array of at most about a
thousand candles.  Pages are independent rows, so reading many of them is their
union.  The result has open_time, close_time and the five numbers, next to any other
column the input carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_CANDLE

# Positions and names in the three payload shapes.
KLINE_FIELDS = {
    "open_time": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "close_time": 6,
}
CANDLE_ARRAY_FIELDS = {"time": 0, "low": 1, "high": 2, "open": 3, "close": 4, "volume": 5}
HISTORY_FIELDS = {
    "open_time": "time_period_start",
    "close_time": "time_period_end",
    "open": "price_open",
    "high": "price_high",
    "low": "price_low",
    "close": "price_close",
    "volume": "volume_traded",
}


def read_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per landed file: its text and its path."""
    return spark.read.text(list(paths), wholetext=True).select(
        F.col("value").alias("payload"), F.input_file_name().alias("page")
    )


def _items(pages: DataFrame, payload: str, json_type: str) -> DataFrame:
    rest = [c for c in pages.columns if c != payload]
    return pages.select(*rest, F.explode(F.from_json(payload, json_type)).alias("_item"))


def _candles(items: DataFrame, fields: dict[str, Column]) -> DataFrame:
    rest = [c for c in items.columns if c != "_item"]
    return items.select(*rest, *[fields[c].alias(c) for c in RAW_CANDLE])


def decode_klines(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Arrays of 12 with epoch milliseconds and numbers as text."""
    items = _items(pages, payload, "array<array<string>>")
    fields = {c: F.try_element_at("_item", F.lit(i + 1)) for c, i in KLINE_FIELDS.items()}
    return _candles(items, fields)


def decode_candle_arrays(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Arrays [time, low, high, open, close, volume] with epoch seconds."""
    items = _items(pages, payload, "array<array<string>>")
    fields = {c: F.try_element_at("_item", F.lit(i + 1)) for c, i in CANDLE_ARRAY_FIELDS.items()}
    opened = F.timestamp_seconds(fields.pop("time").try_cast("double"))
    fields |= {"open_time": opened, "close_time": opened + F.expr("INTERVAL 1 MINUTE")}
    return _candles(items, fields)


def decode_history_objects(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Objects with ISO times and vendor field names."""
    struct = ",".join(f"{name}:string" for name in HISTORY_FIELDS.values())
    items = _items(pages, payload, f"array<struct<{struct}>>")
    return _candles(items, {c: F.col("_item")[name] for c, name in HISTORY_FIELDS.items()})


def unreadable_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Pages that are not a JSON array, such as an error text."""
    return pages.where(F.from_json(payload, "array<string>").isNull())


DECODERS = {
    "binance": decode_klines,
    "coinbase": decode_candle_arrays,
    "coinapi": decode_history_objects,
}
