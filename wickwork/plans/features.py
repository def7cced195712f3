"""The feature set: returns, volatility, volume, Ichimoku lines and signals."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..config import CHUNK_ROWS
from ..functions import series as S
from ..operators.chunks import CHUNK, Halo, chunk_window, own_rows, split_with_halo
from ..operators.rolling import Rolling, with_rolling
from ..schema import FEATURES

# Horizons in rows.
RETURN_HORIZONS = (1, 5, 15, 60)
LAGS = (1, 5, 15, 60)
TENKAN, KIJUN, SPAN_B = 9, 26, 52
SIGNAL_LAG = 5
HOUR, DAY = 60, 1440
MINUTES_PER_YEAR = 525_600

_RETURN = Halo(back=1)
RETURNS_HALO = Halo(back=max(RETURN_HORIZONS))
LAGGED_HALO = Halo(back=max(LAGS)) + _RETURN
VOLATILITY_HALO = Halo(back=DAY - 1) + _RETURN
VOLUME_HALO = Halo(back=HOUR - 1)
ICHIMOKU_HALO = Halo(back=max(TENKAN, KIJUN, SPAN_B) - 1)
SIGNAL_HALO = ICHIMOKU_HALO + Halo(back=SIGNAL_LAG)
FEATURE_HALO = RETURNS_HALO | LAGGED_HALO | VOLATILITY_HALO | VOLUME_HALO | SIGNAL_HALO

VOLATILITY = [
    Rolling("vol_60m", "std", "logret_1m", HOUR),
    Rolling("vol_1d", "std", "logret_1m", DAY),
]
VOLUME = [
    Rolling("vol_ma_60m", "avg", "volume", HOUR),
    Rolling("vol_std_60m", "std", "volume", HOUR),
]


def with_returns(df: DataFrame, w: WindowSpec, horizons=RETURN_HORIZONS) -> DataFrame:
    return df.withColumns(
        {f"logret_{n}m": S.log_return("close_price", n, w) for n in horizons}
    )


def with_lagged_returns(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumns(
        {f"lag_logret_1m_{n}": S.lag_feature("logret_1m", n, w) for n in LAGS}
    )


def with_log_volume(df: DataFrame) -> DataFrame:
    return df.withColumn("log_volume", S.log_volume("volume"))


def with_ichimoku(df: DataFrame, keys: list[str]) -> DataFrame:
    lines = {"tenkan": TENKAN, "kijun": KIJUN, "span_b": SPAN_B}
    ends = {"max": "high_price", "min": "low_price"}
    specs = [Rolling(f"_{line}_{e}", e, c, n) for line, n in lines.items() for e, c in ends.items()]
    return (
        with_rolling(df, specs, keys)
        .withColumns({line: S.ichimoku_midpoint(f"_{line}_max", f"_{line}_min") for line in lines})
        .withColumn("span_a", (F.col("tenkan") + F.col("kijun")) / 2)
        .drop(*[s.name for s in specs])
    )


def with_volatility_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "vol_annualized": F.col("vol_60m") * math.sqrt(MINUTES_PER_YEAR),
            "vol_ratio": S.safe_divide("vol_60m", "vol_1d"),
        }
    )


def with_volume_zscore(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "vol_zscore", S.safe_divide(F.col("volume") - F.col("vol_ma_60m"), "vol_std_60m")
    )


def with_distances(df: DataFrame) -> DataFrame:
    close = F.col("close_price")
    distances = {
        f"{line}_dist": S.safe_divide(close - F.col(line), close)
        for line in ("tenkan", "kijun", "span_a", "span_b")
    }
    thickness = S.safe_divide(F.abs(F.col("span_a") - F.col("span_b")), close)
    return df.withColumns({**distances, "cloud_thickness": thickness})


def _above_cloud():
    return F.col("close_price") > S.strict_greatest("span_a", "span_b")


def with_signals(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "tenkan_sup_kijun": S.binary_signal(F.col("tenkan") > F.col("kijun")),
            "price_sup_cloud": S.binary_signal(_above_cloud()),
            "price_sub_cloud": S.binary_signal(
                F.col("close_price") < S.strict_least("span_a", "span_b")
            ),
        }
    )


def with_lagged_signal(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumn(
        f"lag_price_sup_cloud_{SIGNAL_LAG}",
        S.lag_feature(S.binary_signal(_above_cloud()), SIGNAL_LAG, w),
    )


def over_series(candles: DataFrame, halo: Halo, build, chunk_rows: int | None = CHUNK_ROWS):
    """Run ``build(df, window, keys)`` over chunks that see the rows they need."""
    chunked = split_with_halo(candles, halo, chunk_rows)
    return own_rows(build(chunked, chunk_window(), ["series_id", CHUNK]))


def feature_set(candles: DataFrame, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    """All 28 features of each candle.

    ``candles`` is silver; it is read twice (plan of the chunks, data), so pass a
    written or pinned table.  The plain windows share the sort after the shuffle on
    (series, chunk); the block-wise statistics add two sorts and no shuffle.
    """

    def build(df, w, keys):
        df = with_ichimoku(with_returns(df, w), keys)
        df = with_lagged_signal(with_lagged_returns(df, w), w)
        return with_rolling(df, VOLATILITY + VOLUME, keys)

    df = over_series(
        candles.select(
            "series_id",
            "symbol",
            "timeframe",
            "ts",
            "ingested_at",
            "source",
            "high_price",
            "low_price",
            "close_price",
            "volume",
        ),
        FEATURE_HALO,
        build,
        chunk_rows,
    )
    df = with_volume_zscore(with_volatility_ratios(with_log_volume(df)))
    df = with_signals(with_distances(df))
    return df.select(
        "series_id",
        "symbol",
        "timeframe",
        "ts",
        F.col("ingested_at").alias("raw_ingested_at"),
        "source",
        *FEATURES,
    )
