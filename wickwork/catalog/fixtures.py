"""Candle-shaped inputs made from the driver's tables.

``events`` becomes one-minute candles per event type; minutes without an event are
natural gaps.  The SQL constants are the same inputs for the comparison engine.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BRONZE
from ..session import pinned


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


MARK = utc(2024, 1, 22)
AS_OF = utc(2024, 2, 1)

BARS = """
SELECT event_type AS series_id, date_trunc('minute', ts) AS ts,
       arg_min(value, ts) AS open_price, max(value) AS high_price,
       min(value) AS low_price, arg_max(value, ts) AS close_price,
       sum(value) AS volume
FROM events GROUP BY 1, 2
"""

BRONZE_SQL = f"""
WITH bars AS ({BARS}),
first_pass AS (
  SELECT series_id, ts AS open_time, ts + INTERVAL 1 MINUTE AS close_time,
         open_price AS open,
         CASE WHEN minute(ts) % 20 = 7 THEN low_price - 1 ELSE high_price END AS high,
         low_price AS low,
         CASE WHEN minute(ts) % 20 = 11 THEN NULL ELSE close_price END AS close,
         volume, series_id AS symbol, '1m' AS "interval", 'src_a' AS source,
         ts + INTERVAL 1 DAY AS extracted_at
  FROM bars),
second_pass AS (
  SELECT series_id, ts AS open_time, ts + INTERVAL 1 MINUTE AS close_time, open_price AS open,
         high_price AS high, low_price AS low, close_price AS close, volume,
         series_id AS symbol, '1m' AS "interval", 'src_b' AS source,
         ts + INTERVAL 8 DAY AS extracted_at
  FROM bars WHERE hour(ts) % 2 = 0)
SELECT * FROM first_pass UNION ALL SELECT * FROM second_pass
"""

RUN_LOG_SQL = """
SELECT CAST(event_id AS VARCHAR) AS run_id,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       ts AS started_at, value AS duration_seconds,
       (user_id + 1) * 100 AS rows_extracted,
       (user_id + 1) * 100 - event_id % 7 AS rows_loaded
FROM events
"""

STEPS_SQL = """
SELECT event_id AS step_no,
       CASE WHEN event_id % 3 = 0 THEN 'test' ELSE 'model' END AS resource_type,
       CASE WHEN event_id % 3 = 0 THEN 't_' ELSE 'm_' END || user_id AS model_name,
       CASE event_id % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'pass' WHEN 2 THEN 'error'
                         WHEN 3 THEN 'fail' ELSE 'warn' END AS status,
       value AS execution_time,
       'step ' || event_id || ' of ' || event_type AS message
FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candle per event type and minute; ticks are reduced before the shuffle."""
    events = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return events.groupBy(
        F.col("event_type").alias("series_id"), F.date_trunc("minute", ts).alias("ts")
    ).agg(
        F.min_by("value", "ts").alias("open_price"),
        F.max("value").alias("high_price"),
        F.min("value").alias("low_price"),
        F.max_by("value", "ts").alias("close_price"),
        F.sum("value").alias("volume"),
    )


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candles in silver layout."""
    return bars(spark, sf_dir).withColumns(
        {
            "symbol": F.col("series_id"),
            "timeframe": F.lit("1m"),
            "source": F.lit("events"),
            "ingested_at": F.col("ts") + F.expr("INTERVAL 1 DAY"),
            "is_closed": F.lit(True),
        }
    )


def pinned_candles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Materialised once: windows read their input twice, and the ticks are far larger.

    Only ``columns`` are kept, all of them by default: nothing is pruned behind a checkpoint.
    """
    rows = candles(spark, sf_dir)
    return pinned(rows.select(*columns) if columns else rows)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candle extracted once, those of even hours twice; the first pass has defects.

    Both passes come from one aggregation of the ticks.
    """
    minute = F.minute("ts") % 20

    def extraction(high: Column, close: Column, source: str, days: int) -> Column:
        return F.struct(
            F.col("ts").alias("open_time"),
            (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("close_time"),
            F.col("open_price").alias("open"),
            high.alias("high"),
            F.col("low_price").alias("low"),
            close.alias("close"),
            "volume",
            F.col("series_id").alias("symbol"),
            F.lit("1m").alias("interval"),
            F.lit(source).alias("source"),
            (F.col("ts") + F.expr(f"INTERVAL {days} DAYS")).alias("extracted_at"),
        )

    high = F.when(minute == 7, F.col("low_price") - 1).otherwise(F.col("high_price"))
    close = F.when(minute != 11, F.col("close_price"))
    first = extraction(high, close, "src_a", 1)
    second = extraction(F.col("high_price"), F.col("close_price"), "src_b", 8)
    passes = F.when(F.hour("ts") % 2 == 0, F.array(first, second)).otherwise(F.array(first))
    return bars(spark, sf_dir).select("series_id", F.inline(passes))


def bronze_only(df: DataFrame) -> DataFrame:
    return df.select(*BRONZE.names)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (F.col("user_id") + 1) * 100
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.col("value").alias("duration_seconds"),
        rows.alias("rows_extracted"),
        (rows - F.col("event_id") % 7).alias("rows_loaded"),
    )


STATUS_CYCLE = ["success", "pass", "error", "fail", "warn"]


def step_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, holding one step result."""
    is_test = F.col("event_id") % 3 == 0
    user, number = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    unique_id = F.when(is_test, F.concat(F.lit("test.p.t_"), user, F.lit(".h"), number)).otherwise(
        F.concat(F.lit("model.p.m_"), user)
    )
    status = F.element_at(
        F.array(*[F.lit(s) for s in STATUS_CYCLE]), (F.col("event_id") % 5 + 1).cast("int")
    )
    result = F.struct(
        unique_id.alias("unique_id"),
        status.alias("status"),
        F.col("value").alias("execution_time"),
        F.concat(F.lit("step "), number, F.lit(" of "), F.col("event_type")).alias("message"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step_no"),
        F.to_json(F.struct(F.array(result).alias("results"))).alias("document"),
    )


def pages(spark: SparkSession, sf_dir: str, item: Column) -> DataFrame:
    """Candles encoded as landed JSON pages, one per series and day (at most 1,440 items)."""
    return (
        bars(spark, sf_dir)
        .groupBy("series_id", F.to_date("ts").alias("day"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("payload"))
        .drop("day")
    )


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def kline_item() -> Column:
    opened = F.unix_millis("ts")
    quoted = [
        F.concat(F.lit('"'), _text(c), F.lit('"'))
        for c in ("open_price", "high_price", "low_price", "close_price", "volume")
    ]
    tail = [F.lit('"0"'), F.lit("1"), F.lit('"0"'), F.lit('"0"'), F.lit('"0"')]
    parts = [_text(opened), *quoted, _text(opened + 59_999), *tail]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def candle_array_item() -> Column:
    parts = [
        _text(F.unix_seconds("ts")),
        *[_text(c) for c in ("low_price", "high_price", "open_price", "close_price", "volume")],
    ]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def history_item() -> Column:
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'"
    ended = F.col("ts") + F.expr("INTERVAL 1 MINUTE")
    return F.to_json(
        F.struct(
            F.date_format("ts", iso).alias("time_period_start"),
            F.date_format(ended, iso).alias("time_period_end"),
            F.col("open_price").alias("price_open"),
            F.col("high_price").alias("price_high"),
            F.col("low_price").alias("price_low"),
            F.col("close_price").alias("price_close"),
            F.col("volume").alias("volume_traded"),
        )
    )
