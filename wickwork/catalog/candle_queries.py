"""Scans, normalisation, silver and the filters between the layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import truncate_text, week_start
from ..operators import candles as C
from ..operators.dedupe import keep_first
from ..operators.standardize import coerce_numeric, parse_mixed_ts, standardize
from ..operators.validate import source_fallback, validate_batches
from ..schema import NUMBERS
from ..session import scratch_folder
from ..sources import payloads, tables
from ..sources.steps import parse_step_results
from . import fixtures as X
from .registry import query

# Values that were summed or put through ln and sqrt agree to six decimals.
ROUNDED = 6


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, ROUNDED) for c in columns})


_BRONZE_OUT = (
    'open_time, close_time, open, high, low, close, round(volume, 6) AS volume, symbol, '
    '"interval", source, extracted_at'
)


@query("scan_bronze", f"SELECT {_BRONZE_OUT} FROM ({X.BRONZE_SQL})")
def scan_bronze(spark, d):
    folder = scratch_folder(spark, "bronze")
    tables.write_bronze(X.bronze_only(X.bronze(spark, d)), folder)
    return _rounded(tables.read_bronze(spark, folder), "volume")


@query(
    "bronze_union",
    f"""WITH b AS ({X.BRONZE_SQL})
    SELECT {_BRONZE_OUT} FROM b WHERE open_time < TIMESTAMP '2024-01-15'
    UNION ALL
    SELECT {_BRONZE_OUT} FROM b WHERE open_time >= TIMESTAMP '2024-01-14'""",
)
def bronze_union(spark, d):
    b = X.bronze(spark, d)
    history = b.where(F.col("open_time") < F.lit(X.utc(2024, 1, 15)))
    weekly = b.where(F.col("open_time") >= F.lit(X.utc(2024, 1, 14)))
    return _rounded(tables.bronze_union(history, weekly), "volume")


def _normalised_sql(close_time: str, source: str) -> str:
    return f"""SELECT ts AS open_time, {close_time} AS close_time, open_price AS open,
      high_price AS high, low_price AS low, close_price AS close, round(volume, 6) AS volume,
      series_id AS symbol, '1m' AS "interval", '{source}' AS source,
      TIMESTAMP '2024-02-01' AS extracted_at FROM ({X.BARS})"""


def _normalised(raw, source):
    out = standardize(raw, F.col("series_id"), source, F.lit(X.AS_OF))
    return _rounded(out, "volume")


@query("norm_klines", _normalised_sql("ts + INTERVAL 59999 MILLISECOND", "binance"))
def norm_klines(spark, d):
    return _normalised(payloads.decode_klines(X.pages(spark, d, X.kline_item())), "binance")


@query("norm_candle_arrays", _normalised_sql("ts + INTERVAL 1 MINUTE", "coinbase"))
def norm_candle_arrays(spark, d):
    pages = X.pages(spark, d, X.candle_array_item())
    return _normalised(payloads.decode_candle_arrays(pages), "coinbase")


@query("norm_history_objects", _normalised_sql("ts + INTERVAL 1 MINUTE", "coinapi"))
def norm_history_objects(spark, d):
    pages = X.pages(spark, d, X.history_item())
    return _normalised(payloads.decode_history_objects(pages), "coinapi")


@query(
    "standardize_ohlcv",
    f"""SELECT open_time, close_time, open, high, low, close, round(volume, 6) AS volume, symbol,
      "interval", 'vendor' AS source, TIMESTAMP '2024-02-01' AS extracted_at
    FROM ({X.BRONZE_SQL})
    QUALIFY row_number() OVER (PARTITION BY symbol, open_time
      ORDER BY (close_time IS NULL)::INT + (open IS NULL)::INT + (high IS NULL)::INT
               + (low IS NULL)::INT + (close IS NULL)::INT + (volume IS NULL)::INT,
               close_time NULLS FIRST, open NULLS FIRST, high NULLS FIRST, low NULLS FIRST,
               close NULLS FIRST, volume NULLS FIRST) = 1""",
)
def standardize_ohlcv(spark, d):
    raw = X.bronze(spark, d).withColumns({c: F.col(c).cast("string") for c in NUMBERS})
    return _rounded(standardize(raw, F.col("symbol"), "vendor", F.lit(X.AS_OF)), "volume")


@query(
    "coerce_numeric",
    """SELECT event_id, value AS from_value, TRY_CAST(props AS DOUBLE) AS from_props,
      TRY_CAST(CASE WHEN event_id % 4 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END
        AS DOUBLE) AS from_mixed FROM events""",
)
def coerce(spark, d):
    user = F.col("user_id").cast("string")
    mixed = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(user)
    return X.table(spark, d, "events").select(
        "event_id",
        coerce_numeric(F.col("value").cast("string")).alias("from_value"),
        coerce_numeric("props").alias("from_props"),
        coerce_numeric(mixed).alias("from_mixed"),
    )


@query(
    "parse_mixed_ts",
    """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL
        WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) ELSE ts END AS parsed
    FROM events""",
)
def parse_ts(spark, d):
    ts = F.col("ts").cast("timestamp")
    text = (
        F.when(F.col("event_id") % 5 == 4, F.col("event_type"))
        .when(F.col("event_id") % 2 == 0, F.unix_millis(ts).cast("string"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    return X.table(spark, d, "events").select("event_id", parse_mixed_ts(text).alias("parsed"))


_SILVER_WHERE = "open_time IS NOT NULL AND close IS NOT NULL AND high >= low"
_CANDLE = "series_id, open_time, high, low, close, source, extracted_at"


@query("silver_filter", f"SELECT {_CANDLE} FROM ({X.BRONZE_SQL}) WHERE {_SILVER_WHERE}")
def silver_filter(spark, d):
    return C.silver_filter(X.bronze(spark, d)).select(*_CANDLE.split(", "))


@query(
    "dedupe_latest",
    f"""SELECT {_CANDLE} FROM ({X.BRONZE_SQL}) QUALIFY row_number() OVER
    (PARTITION BY series_id, open_time ORDER BY extracted_at DESC, source) = 1""",
)
def dedupe_latest(spark, d):
    return C.dedupe_latest(X.bronze(spark, d)).select(*_CANDLE.split(", "))


@query(
    "dedupe_first",
    f"""SELECT {_CANDLE} FROM ({X.BRONZE_SQL}) QUALIFY row_number() OVER
    (PARTITION BY series_id, open_time ORDER BY extracted_at, source) = 1""",
)
def dedupe_first(spark, d):
    first = keep_first(X.bronze(spark, d), ["series_id", "open_time"], ["extracted_at", "source"])
    return first.select(*_CANDLE.split(", "))


@query(
    "silver",
    f"""SELECT series_id, symbol, open_time AS ts, '1m' AS timeframe, open AS open_price,
      high AS high_price, low AS low_price, close AS close_price, round(volume, 6) AS volume,
      source, extracted_at AS ingested_at, TRUE AS is_closed
    FROM ({X.BRONZE_SQL}) WHERE {_SILVER_WHERE}
    QUALIFY row_number() OVER
      (PARTITION BY series_id, open_time ORDER BY extracted_at DESC, source) = 1""",
)
def silver(spark, d):
    return _rounded(C.silver(X.bronze(spark, d), mapping={}), "volume")


@query(
    "raw_projection",
    f"""SELECT symbol, open_time AS ts, "interval" AS timeframe, open AS open_price,
      high AS high_price, low AS low_price, close AS close_price, round(volume, 6) AS volume,
      source, extracted_at AS ingested_at, TRUE AS is_closed FROM ({X.BRONZE_SQL})""",
)
def raw_projection(spark, d):
    return _rounded(C.raw_projection(X.bronze(spark, d)), "volume")


@query("working_copy", "SELECT * FROM orders")
def working_copy(spark, d):
    return C.working_copy(X.table(spark, d, "orders"))


_BAR = "series_id, ts, open_price, close_price"


@query(
    "prev_full_week",
    f"""SELECT {_BAR} FROM ({X.BARS})
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""",
)
def prev_full_week(spark, d):
    week = C.in_previous_week(X.bars(spark, d), X.utc(2024, 1, 17, 12, 30), ts="ts")
    return week.select(*_BAR.split(", "))


@query(
    "window_filter",
    f"""SELECT {_BAR} FROM ({X.BARS})
    WHERE ts >= TIMESTAMP '2024-01-03 06:00:00' AND ts < TIMESTAMP '2024-01-05 18:30:00'""",
)
def window_filter(spark, d):
    start, end = X.utc(2024, 1, 3, 6), X.utc(2024, 1, 5, 18, 30)
    return C.in_window(X.bars(spark, d), start, end, ts="ts").select(*_BAR.split(", "))


@query("cutoff_filter", f"SELECT {_BAR} FROM ({X.BARS}) WHERE ts < TIMESTAMP '2024-01-13 01:12:00'")
def cutoff_filter(spark, d):
    return C.before_cutoff(X.bars(spark, d), X.utc(2024, 1, 13, 1, 12)).select(*_BAR.split(", "))


@query("closed_candles", f"SELECT {_BAR} FROM ({X.BARS}) WHERE series_id = 'click'")
def closed_candles(spark, d):
    return C.closed_candles(X.candles(spark, d), symbol="click").select(*_BAR.split(", "))


@query(
    "missing_values",
    f"""SELECT open_time, open, high, low, close, round(volume, 6) AS volume
    FROM ({X.BRONZE_SQL}) WHERE open_time IS NULL OR open IS NULL OR high IS NULL
      OR low IS NULL OR close IS NULL OR volume IS NULL""",
)
def missing_values(spark, d):
    columns = ["open_time", *NUMBERS]
    return _rounded(C.missing_values(X.bronze(spark, d), columns).select(*columns), "volume")


@query(
    "backfill_defaults",
    f"""SELECT series_id, open_time, source, coalesce(close, 0) AS close
    FROM ({X.BRONZE_SQL})""",
)
def backfill_defaults(spark, d):
    filled = C.backfill_defaults(X.bronze(spark, d), {"close": 0.0})
    return filled.select("series_id", "open_time", "source", "close")


@query(
    "evolve_schema",
    f"""SELECT ts, close_price,
      CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'BTC/USDT' ELSE series_id END AS symbol,
      '1m' AS timeframe FROM ({X.BARS})""",
)
def evolve_schema(spark, d):
    b = X.candles(spark, d)
    cut = F.lit(X.utc(2024, 1, 15))
    old = b.where(F.col("ts") < cut).select("ts", "close_price")
    new = b.where(F.col("ts") >= cut).select("ts", "close_price", "symbol", "timeframe")
    return C.evolve_schema(old, new, {"symbol": "BTC/USDT", "timeframe": "1m"})


@query(
    "truncate_text",
    f"""SELECT step_no, substring(repeat(message || '; ', 60), 1, 1000) AS message
    FROM ({X.STEPS_SQL})""",
)
def truncate(spark, d):
    steps = parse_step_results(X.step_documents(spark, d))
    trace = F.expr("repeat(message || '; ', 60)")
    return steps.select("step_no", truncate_text(trace).alias("message"))


_WEEK_BATCH = f"""
SELECT series_id AS source, ts AS open_time, date_trunc('week', ts) AS week_start,
  date_trunc('week', ts) + INTERVAL 7 DAY AS week_end, open_price AS open,
  CASE WHEN series_id = 'view' AND minute(ts) = 7 THEN low_price - 1 ELSE high_price END AS high,
  low_price AS low, close_price AS close, volume
FROM ({X.BARS})
"""


def _week_batches(spark, d):
    b = X.bars(spark, d)
    inverted = (F.col("series_id") == "view") & (F.minute("ts") == 7)
    return b.select(
        F.col("series_id").alias("source"),
        F.col("ts").alias("open_time"),
        week_start("ts").alias("week_start"),
        (week_start("ts") + F.expr("INTERVAL 7 DAYS")).alias("week_end"),
        F.col("open_price").alias("open"),
        F.when(inverted, F.col("low_price") - 1).otherwise(F.col("high_price")).alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        "volume",
    )


# Weekly candles exist for about one minute in twenty of each event type.
_RATIO = 0.045

_VERDICTS = f"""
SELECT source, week_start, week_end, count(*) AS rows,
  count(*) - count(DISTINCT open_time) AS duplicate_times,
  count(*) FILTER (WHERE high < low) AS inverted_rows,
  CAST(floor(10080 * {_RATIO}) AS BIGINT) AS min_rows,
  count(*) = count(DISTINCT open_time) AND count(*) FILTER (WHERE high < low) = 0
    AND count(*) >= floor(10080 * {_RATIO}) AS is_valid
FROM week_batch GROUP BY source, week_start, week_end
"""


@query(
    "validate_batch",
    f"""WITH week_batch AS (
      SELECT * FROM ({_WEEK_BATCH})
      UNION ALL SELECT * FROM ({_WEEK_BATCH}) WHERE source = 'signup' AND hour(open_time) = 3)
    {_VERDICTS}""",
)
def validate_batch(spark, d):
    batch = _week_batches(spark, d)
    again = batch.where((F.col("source") == "signup") & (F.hour("open_time") == 3))
    return validate_batches(
        batch.unionByName(again), ["source"], "week_start", "week_end", _RATIO
    )


@query(
    "source_fallback",
    f"""WITH week_batch AS ({_WEEK_BATCH}), verdicts AS ({_VERDICTS}),
    winner AS (SELECT week_start, min(source) AS source FROM verdicts WHERE is_valid GROUP BY 1)
    SELECT b.week_start, b.source, b.open_time, b.open, b.high, b.low, b.close
    FROM week_batch b JOIN winner USING (week_start, source)""",
)
def fallback(spark, d):
    priority = ["click", "error", "purchase", "signup", "view"]
    chosen = source_fallback(
        _week_batches(spark, d), priority, [], "week_start", "week_end", _RATIO
    )
    return chosen.select("week_start", "source", "open_time", "open", "high", "low", "close")
