"""Schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Landed candles, one row per candle and extraction.
BRONZE = T.StructType(
    [
        T.StructField("open_time", T.TimestampType()),
        T.StructField("close_time", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)

PRICES = ["open", "high", "low", "close"]
NUMBERS = [*PRICES, "volume"]
RAW_CANDLE = ["open_time", "close_time", *NUMBERS]
REQUIRED = ["open_time", *NUMBERS]

SILVER_COLUMNS = [
    "series_id",
    "symbol",
    "ts",
    "timeframe",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "source",
    "ingested_at",
    "is_closed",
]

# Header of the historical CSV file.
HISTORY_CSV = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ["timestamp", *NUMBERS]]
)

# The feature list of version 1, in table order.
FEATURES = [
    "logret_1m",
    "logret_5m",
    "logret_15m",
    "logret_60m",
    "lag_logret_1m_1",
    "lag_logret_1m_5",
    "lag_logret_1m_15",
    "lag_logret_1m_60",
    "vol_60m",
    "vol_1d",
    "vol_annualized",
    "vol_ratio",
    "log_volume",
    "vol_ma_60m",
    "vol_zscore",
    "tenkan",
    "kijun",
    "span_a",
    "span_b",
    "tenkan_dist",
    "kijun_dist",
    "span_a_dist",
    "span_b_dist",
    "cloud_thickness",
    "tenkan_sup_kijun",
    "price_sup_cloud",
    "price_sub_cloud",
    "lag_price_sup_cloud_5",
]
SIGNALS = FEATURES[-4:]
LABELS = ["y_logret_5m", "y_logret_15m", "y_shock_15m"]

# Version row, candle interval and accepted candle intervals.
VERSION_ID = "v1"
VERSION_TAG = "v1.0"
VERSION_DESCRIPTION = "Returns, volatility, volume and cloud features of one-minute candles"
INTERVAL = "1m"
TIMEFRAMES = ["1m", "5m", "15m", "1h", "4h", "12h", "1d"]

# Vendors in the order they are tried, and the symbol each one uses.
SOURCE_PRIORITY = ["binance", "coinbase", "coinapi"]
SYMBOL_BY_SOURCE = {
    "binance": "BTCUSDT",
    "coinbase": "BTC-USD",
    "coinapi": "BITSTAMP_SPOT_BTC_USD",
}
# Every spelling of the asset, including the ones of older tables.
SERIES_BY_SYMBOL = {
    "BTCUSDT": "BTC",
    "BTC-USD": "BTC",
    "BITSTAMP_SPOT_BTC_USD": "BTC",
    "BTC/USDT": "BTC",
    "btc": "BTC",
}

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("rows_extracted", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("github_sha", T.StringType()),
        T.StructField("image_uri", T.StringType()),
    ]
)

STEP_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("resource_type", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("compiled_code", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

QUALITY_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CHECKPOINT_LOG = T.StructType(
    [
        T.StructField("version_id", T.StringType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def series_of(symbol: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """Canonical series of a vendor symbol; an unknown symbol is its own series.

    Vendors spell one asset differently, so windows partitioned by the raw symbol
    would cut a series wherever another vendor delivered a week.
    """
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    mapping = SERIES_BY_SYMBOL if mapping is None else mapping
    if not mapping:
        return symbol
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, symbol), symbol)


def naive_utc(df: DataFrame) -> DataFrame:
    """Timestamps without zone, for comparison with engines that have only those."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )
