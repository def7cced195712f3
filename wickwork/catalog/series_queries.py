"""Window features, labels, marts and increments over the candles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import series as S
from ..operators.chunks import Halo
from ..operators.keys import cross_active_version as tag_version
from ..operators.rolling import with_rolling
from ..plans import features as P
from ..plans import labels as L
from ..plans import marts as M
from ..plans.versions import feature_versions
from ..schema import FEATURES, SIGNALS
from ..session import pinned
from . import fixtures as X
from .registry import query

KEY = ["series_id", "ts"]


# Decimals to which the engines agree.  Maxima, minima and plain arithmetic agree bit
# by bit; an average of prices in cents may end in a 5 at the seventh decimal.
_LINES = ["tenkan", "kijun", "span_a", "span_b"]
_DISTANCES = [*[f"{line}_dist" for line in _LINES], "cloud_thickness"]
_EXACT = {*KEY, *_LINES, *_DISTANCES, *SIGNALS}
_DECIMALS = {"vol_ma_60m": 7}


def _out(df, *columns):
    """The columns, doubles that are not exact rounded."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    rounded = doubles - _EXACT
    return df.select(
        *[F.round(c, _DECIMALS.get(c, 6)).alias(c) if c in rounded else F.col(c) for c in columns]
    )


def _ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


def _back(n: int) -> str:
    return _ln(f"(close_price / NULLIF(lag(close_price, {n}) OVER w, 0))")


def _ahead(n: int) -> str:
    return _ln(f"(lead(close_price, {n}) OVER w / NULLIF(close_price, 0))")



def _rows(n: int) -> str:
    return f"PARTITION BY series_id ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def _mid(n: int) -> str:
    return f"(max(high_price) OVER ({_rows(n)}) + min(low_price) OVER ({_rows(n)})) / 2"


def _std(c: str, n: int) -> str:
    return f"stddev_samp({c}) OVER ({_rows(n)})"


_W = "WINDOW w AS (PARTITION BY series_id ORDER BY ts)"

_RETURNS = f"""
returns AS (
  SELECT *, {_back(1)} AS logret_1m, {_back(5)} AS logret_5m, {_back(15)} AS logret_15m,
    {_back(60)} AS logret_60m, {_ln("NULLIF(volume, 0)")} AS log_volume
  FROM bars {_W}),
ichimoku AS (
  SELECT *, {_mid(9)} AS tenkan, {_mid(26)} AS kijun, {_mid(52)} AS span_b FROM returns),
feat AS (
  SELECT *, (tenkan + kijun) / 2 AS span_a,
    {_std("logret_1m", 60)} AS vol_60m, {_std("logret_1m", 1440)} AS vol_1d,
    avg(volume) OVER ({_rows(60)}) AS vol_ma_60m, {_std("volume", 60)} AS vol_std_60m
  FROM ichimoku),
features AS (
  SELECT *,
    lag(logret_1m, 1) OVER w AS lag_logret_1m_1, lag(logret_1m, 5) OVER w AS lag_logret_1m_5,
    lag(logret_1m, 15) OVER w AS lag_logret_1m_15, lag(logret_1m, 60) OVER w AS lag_logret_1m_60,
    vol_60m * sqrt(525600) AS vol_annualized, vol_60m / NULLIF(vol_1d, 0) AS vol_ratio,
    (volume - vol_ma_60m) / NULLIF(vol_std_60m, 0) AS vol_zscore,
    (close_price - tenkan) / NULLIF(close_price, 0) AS tenkan_dist,
    (close_price - kijun) / NULLIF(close_price, 0) AS kijun_dist,
    (close_price - span_a) / NULLIF(close_price, 0) AS span_a_dist,
    (close_price - span_b) / NULLIF(close_price, 0) AS span_b_dist,
    abs(span_a - span_b) / NULLIF(close_price, 0) AS cloud_thickness,
    CAST(CASE WHEN tenkan > kijun THEN 1 ELSE 0 END AS BIGINT) AS tenkan_sup_kijun,
    CAST(CASE WHEN close_price > greatest(span_a, span_b) THEN 1 ELSE 0 END AS BIGINT)
      AS price_sup_cloud,
    CAST(CASE WHEN close_price < least(span_a, span_b) THEN 1 ELSE 0 END AS BIGINT)
      AS price_sub_cloud,
    CAST(lag(CASE WHEN close_price > greatest(span_a, span_b) THEN 1 ELSE 0 END, 5) OVER w
      AS BIGINT) AS lag_price_sup_cloud_5
  FROM feat {_W})
"""

_FEATURES_WITH = f"WITH bars AS ({X.BARS}), {_RETURNS}"


def _rounded_list(columns) -> str:
    """Select list with the roundings of ``_out``."""
    return ", ".join(
        c if c in _EXACT else f"round({c}, {_DECIMALS.get(c, 6)}) AS {c}" for c in columns
    )


def _features_sql(*columns: str) -> str:
    return f"{_FEATURES_WITH} SELECT series_id, ts, {_rounded_list(columns)} FROM features"


_LABELS_WITH = f"""WITH bars AS ({X.BARS}),
ahead AS (SELECT *, {_ahead(5)} AS y_logret_5m, {_ahead(15)} AS y_logret_15m FROM bars {_W}),
labels AS (SELECT *,
    CAST(CASE WHEN abs(y_logret_15m) >= 0.01 THEN 1 ELSE 0 END AS BIGINT) AS y_shock_15m,
    CAST(CASE WHEN abs(y_logret_15m) >= 1.0 THEN 1 ELSE 0 END AS BIGINT) AS y_shock_15m_1
  FROM ahead)"""


def _over(spark, d, halo, build, *columns):
    """``build`` over candles of the named columns only."""
    return P.over_series(X.pinned_candles(spark, d, *KEY, *columns), halo, build)


_LOGRETS = [f"logret_{n}m" for n in P.RETURN_HORIZONS]


@query("log_returns", _features_sql(*_LOGRETS))
def log_returns(spark, d):
    out = _over(spark, d, P.RETURNS_HALO, lambda df, w, keys: P.with_returns(df, w), "close_price")
    return _out(out, *KEY, *_LOGRETS)


@query("log_volume", _features_sql("log_volume"))
def log_volume(spark, d):
    return _out(P.with_log_volume(X.bars(spark, d)), *KEY, "log_volume")


_LAGGED = [f"lag_logret_1m_{n}" for n in P.LAGS]


@query("lagged_returns", _features_sql(*_LAGGED))
def lagged_returns(spark, d):
    def build(df, w, keys):
        return P.with_lagged_returns(P.with_returns(df, w, (1,)), w)

    return _out(_over(spark, d, P.LAGGED_HALO, build, "close_price"), *KEY, *_LAGGED)


def _volatility(df, w, keys):
    return with_rolling(P.with_returns(df, w, (1,)), P.VOLATILITY, keys)


@query("rolling_std", _features_sql("vol_60m", "vol_1d"))
def rolling_std(spark, d):
    return _out(_over(spark, d, P.VOLATILITY_HALO, _volatility, "close_price"), *KEY, "vol_60m", "vol_1d")


@query("rolling_avg", _features_sql("vol_ma_60m"))
def rolling_avg(spark, d):
    def build(df, w, keys):
        return with_rolling(df, P.VOLUME[:1], keys)

    out = _over(spark, d, P.VOLUME_HALO, build, "volume")
    return _out(out, *KEY, "vol_ma_60m")


_BAR = ["high_price", "low_price", "close_price"]


def _ichimoku(df, w, keys):
    return P.with_ichimoku(df, keys)


@query("ichimoku", _features_sql(*_LINES))
def ichimoku(spark, d):
    return _out(_over(spark, d, P.ICHIMOKU_HALO, _ichimoku, *_BAR), *KEY, *_LINES)


@query("volatility", _features_sql("vol_annualized", "vol_ratio"))
def volatility(spark, d):
    out = P.with_volatility_ratios(_over(spark, d, P.VOLATILITY_HALO, _volatility, "close_price"))
    return _out(out, *KEY, "vol_annualized", "vol_ratio")


@query("volume_zscore", _features_sql("vol_zscore"))
def volume_zscore(spark, d):
    def build(df, w, keys):
        return with_rolling(df, P.VOLUME, keys)

    out = _over(spark, d, P.VOLUME_HALO, build, "volume")
    return _out(P.with_volume_zscore(out), *KEY, "vol_zscore")


@query("ichimoku_distances", _features_sql(*_DISTANCES))
def ichimoku_distances(spark, d):
    out = P.with_distances(_over(spark, d, P.ICHIMOKU_HALO, _ichimoku, *_BAR))
    return _out(out, *KEY, *_DISTANCES)


@query("binary_signals", _features_sql(*SIGNALS[:3]))
def binary_signals(spark, d):
    out = P.with_signals(_over(spark, d, P.ICHIMOKU_HALO, _ichimoku, *_BAR))
    return _out(out, *KEY, *SIGNALS[:3])


@query("lagged_signal", _features_sql(SIGNALS[3]))
def lagged_signal(spark, d):
    def build(df, w, keys):
        return P.with_lagged_signal(P.with_ichimoku(df, keys), w)

    return _out(_over(spark, d, P.SIGNAL_HALO, build, *_BAR), *KEY, SIGNALS[3])


@query("feature_set", _features_sql(*FEATURES))
def feature_set(spark, d):
    return _out(P.feature_set(X.pinned_candles(spark, d)), *KEY, *FEATURES)


# The same results from chunks so short that every series is cut many times.
CUT_ROWS = 300


@query("feature_set_cut", _features_sql(*FEATURES))
def feature_set_cut(spark, d):
    return _out(P.feature_set(X.pinned_candles(spark, d), CUT_ROWS), *KEY, *FEATURES)


_LABEL_COLUMNS = "round(y_logret_5m, 6) AS y_logret_5m, round(y_logret_15m, 6) AS y_logret_15m"


@query("future_returns", f"{_LABELS_WITH} SELECT series_id, ts, {_LABEL_COLUMNS} FROM labels")
def future_returns(spark, d):
    def build(df, w, keys):
        return df.withColumns(
            {f"y_logret_{h}m": S.future_log_return("close_price", h, w) for h in L.LABEL_HORIZONS}
        )

    out = _over(spark, d, L.LABEL_HALO, build, "close_price")
    return _out(out, *KEY, "y_logret_5m", "y_logret_15m")


@query("shock_label", f"{_LABELS_WITH} SELECT series_id, ts, y_shock_15m, y_shock_15m_1 FROM labels")
def shock_label(spark, d):
    def build(df, w, keys):
        return df.withColumns(
            {
                "y_shock_15m": S.shock_label("close_price", L.SHOCK_HORIZON, 0.01, w),
                "y_shock_15m_1": S.shock_label("close_price", L.SHOCK_HORIZON, 1.0, w),
            }
        )

    out = _over(spark, d, Halo(ahead=L.SHOCK_HORIZON), build, "close_price")
    return out.select(*KEY, "y_shock_15m", "y_shock_15m_1")


@query(
    "valid_label_horizon",
    f"""SELECT series_id, ts, close_price FROM ({X.BARS})
    WHERE ts <= TIMESTAMP '2024-01-20' - INTERVAL 15 MINUTE""",
)
def valid_label_horizon(spark, d):
    reference = F.lit(X.utc(2024, 1, 20))
    b = X.bars(spark, d).where(S.valid_label_horizon("ts", 15, reference))
    return b.select("series_id", "ts", "close_price")


def _mart_sql(where: str = "") -> str:
    return f"""{_FEATURES_WITH} SELECT series_id, ts, 'v1' AS version_id,
      ts + INTERVAL 1 DAY AS raw_ingested_at, 'events' AS source, {_rounded_list(FEATURES)},
      series_id AS symbol, '1m' AS timeframe FROM features {where}"""


def _mart_out(mart):
    return _out(mart, *[c for c in mart.columns if c != "computed_at"])


@query("features_mart", _mart_sql())
def features_mart(spark, d):
    versions = feature_versions(spark, X.AS_OF)
    return _mart_out(M.features_mart(X.pinned_candles(spark, d), versions, X.AS_OF))


def _labels_sql(where: str = "") -> str:
    return f"""{_LABELS_WITH} SELECT series_id, ts, 'v1' AS version_id, {_LABEL_COLUMNS},
      y_shock_15m, series_id AS symbol, '1m' AS timeframe FROM labels
    WHERE y_logret_5m IS NOT NULL AND y_logret_15m IS NOT NULL {where}"""


def _label_candles(spark, d):
    return X.pinned_candles(spark, d, *KEY, "symbol", "timeframe", "close_price")


@query("labels_mart", _labels_sql())
def labels_mart(spark, d):
    versions = feature_versions(spark, X.AS_OF)
    return _mart_out(M.labels_mart(_label_candles(spark, d), versions, X.AS_OF))


@query("labels_mart_cut", _labels_sql())
def labels_mart_cut(spark, d):
    versions = feature_versions(spark, X.AS_OF)
    rows = M.labels_mart(_label_candles(spark, d), versions, X.AS_OF, chunk_rows=CUT_ROWS)
    return _mart_out(rows)


@query("feature_increment", _mart_sql("WHERE ts > TIMESTAMP '2024-01-22'"))
def feature_increment(spark, d):
    versions = feature_versions(spark, X.AS_OF)
    rows = M.feature_increment(X.pinned_candles(spark, d), versions, X.MARK, X.AS_OF)
    return _mart_out(rows)


@query("feature_increment_cut", _mart_sql("WHERE ts > TIMESTAMP '2024-01-22'"))
def feature_increment_cut(spark, d):
    versions = feature_versions(spark, X.AS_OF)
    candles = X.pinned_candles(spark, d)
    return _mart_out(M.feature_increment(candles, versions, X.MARK, X.AS_OF, CUT_ROWS))


@query(
    "label_increment",
    _labels_sql(
        "AND ts > CASE series_id WHEN 'click' THEN TIMESTAMP '2024-01-22'"
        " WHEN 'view' THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '1970-01-01' END"
    ),
)
def label_increment(spark, d):
    """A mark per series; series without one are new."""
    versions = feature_versions(spark, X.AS_OF)
    marks = spark.createDataFrame(
        [("click", X.MARK), ("view", X.utc(2024, 1, 10))], "series_id string, mark timestamp"
    )
    rows = M.label_increment(_label_candles(spark, d), versions, marks, X.AS_OF)
    return _mart_out(rows)


_UNTIL_MARK = f"SELECT * FROM ({X.BARS}) WHERE ts <= TIMESTAMP '2024-01-22'"


def _until_mark(bars):
    return bars.where(F.col("ts") <= F.lit(X.MARK))


@query("high_water", f"SELECT series_id, max(ts) AS mark FROM ({_UNTIL_MARK}) GROUP BY 1")
def high_water(spark, d):
    return M.high_water(_until_mark(X.bars(spark, d)), ["series_id"])


@query(
    "incremental_filter",
    f"""WITH marks AS (SELECT series_id, max(ts) AS mark FROM ({_UNTIL_MARK}) GROUP BY 1)
    SELECT b.series_id, b.ts, b.close_price FROM ({X.BARS}) b LEFT JOIN marks USING (series_id)
    WHERE b.ts > coalesce(mark, TIMESTAMP '1970-01-01')""",
)
def incremental_filter(spark, d):
    bars = X.bars(spark, d)
    marks = pinned(M.high_water(_until_mark(bars), ["series_id"]))
    return M.after_mark(bars, marks).select("series_id", "ts", "close_price")


@query(
    "checkpoint_row",
    f"""SELECT series_id, max(ts) AS last_ts,
      count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-22') AS rows_inserted, 'ok' AS status
    FROM ({X.BARS}) GROUP BY 1""",
)
def checkpoint_row(spark, d):
    bars = X.bars(spark, d)
    return M.checkpoint_row(bars, bars.where(F.col("ts") > F.lit(X.MARK)), ["series_id"])


@query(
    "last_checkpoint",
    """SELECT event_type AS version_id, max(ts) AS last_ts FROM events
    WHERE event_id % 7 <> 0 GROUP BY 1""",
)
def last_checkpoint(spark, d):
    log = X.table(spark, d, "events").select(
        F.col("event_type").alias("version_id"),
        F.col("ts").alias("last_ts"),
        F.when(F.col("event_id") % 7 == 0, "error").otherwise("ok").alias("status"),
    )
    return M.last_checkpoint(log)


@query(
    "cross_active_version",
    f"SELECT series_id, ts, close_price, 'v1' AS version_id FROM ({X.BARS})",
)
def cross_active_version(spark, d):
    active = feature_versions(spark, X.AS_OF)
    retired = active.withColumns({"version_id": F.lit("v0"), "is_active": F.lit(False)})
    tagged = tag_version(X.bars(spark, d), active.unionByName(retired))
    return tagged.select("series_id", "ts", "close_price", "version_id")
