"""Parts of the weekly job that write tables: run in a scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Settings
from ..operators import rules as R
from ..plans.days import DayIndex
from ..plans.rule_state import RuleState
from ..plans.weekly import Lake, run_increment, store_silver
from ..session import scratch_folder
from ..sources import tables
from . import fixtures as X
from .registry import query
from .series_queries import _labels_sql, _mart_out, _mart_sql

FOLLOW = Settings(late_rows=True)


def _read(spark, path):
    return spark.read.parquet(path).drop(tables.DAY, tables.VERSION)


def _followed(spark, d):
    """Some hours of every day arrive late, others are corrected later, one day is removed again."""
    lake, candles = Lake(scratch_folder(spark, "lake")), X.pinned_candles(spark, d)
    hour = F.hour("ts")
    first = candles.where((hour % 7 != 3) & (F.col("ts") <= F.lit(X.MARK)))
    first = first.withColumn("close_price", F.when(hour % 11 == 5, 1.0).otherwise(F.col("close_price")))
    wrong = first.where(F.dayofmonth("ts") == 3).withColumn("ts", F.col("ts") - F.expr("INTERVAL 30 DAYS"))
    store_silver(spark, lake, first.unionByName(wrong))
    run_increment(spark, lake, FOLLOW, X.AS_OF)
    for day in tables.days_of(wrong):
        remove = f"{lake.silver}/{tables.DAY}={day:%Y-%m-%d}"
        DayIndex(spark, lake.silver).update([day], lambda path=remove: tables.remove(spark, path))
    store_silver(spark, lake, candles)
    run_increment(spark, lake, FOLLOW, X.AS_OF)
    return lake


_SOME = ["logret_1m", "vol_1d", "span_b", "vol_zscore", "lag_price_sup_cloud_5"]
_MADE = ["y_logret_5m", "y_logret_15m", "y_shock_15m"]


@query(
    "late_marts",
    f"""SELECT series_id, ts, {', '.join(_SOME + _MADE)} FROM ({_mart_sql()}) f
    LEFT JOIN (SELECT series_id, ts, {', '.join(_MADE)} FROM ({_labels_sql()})) l USING (series_id, ts)""",
)
def late_marts(spark, d):
    """Some features of every candle and its labels, where it has any."""
    lake = _followed(spark, d)
    features = _mart_out(_read(spark, lake.features)).select("series_id", "ts", *_SOME)
    labels = _mart_out(_read(spark, lake.labels)).select("series_id", "ts", *_MADE)
    return features.join(labels, ["series_id", "ts"], "left")


@query("refresh_in_windows", _labels_sql())
def refresh_in_windows(spark, d):
    """A full refresh as consecutive windows of at most 3,000 rows or one day."""
    lake = Lake(scratch_folder(spark, "lake"))
    store_silver(spark, lake, X.pinned_candles(spark, d))
    settings = Settings(late_rows=True, window_rows=3000)
    run_increment(spark, lake, settings, X.AS_OF, full_refresh=True)
    return _mart_out(_read(spark, lake.labels))


@query(
    "job_checkpoints",
    f"""WITH b AS ({X.BARS}), first AS (SELECT * FROM b WHERE ts <= TIMESTAMP '2024-01-22')
    SELECT 'v1' AS version_id, max(ts) AS last_ts, count(*) AS rows_inserted, 'ok' AS status FROM first
    UNION ALL
    SELECT 'v1', max(ts), count(*) - (SELECT count(*) FROM first), 'ok' FROM b""",
)
def job_checkpoints(spark, d):
    """The log of two increments."""
    lake, candles = Lake(scratch_folder(spark, "lake")), X.pinned_candles(spark, d)
    for rows in (candles.where(F.col("ts") <= F.lit(X.MARK)), candles):
        store_silver(spark, lake, rows)
        run_increment(spark, lake, as_of=X.AS_OF)
    return spark.read.parquet(lake.checkpoints).select("version_id", "last_ts", "rows_inserted", "status")


def _count_sql(rule: str, column: str, failing: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", ({failing}) AS failed_rows"""


_STATE_SQL = " UNION ALL ".join(
    [
        _count_sql("check", "close", "SELECT count(*) FROM b WHERE NOT (close_price < 250)"),
        _count_sql("not_null", "thin", "SELECT count(*) FROM b WHERE minute(ts) % 10 = 0"),
        _count_sql("accepted_values", "series_id", "SELECT count(*) FROM b WHERE series_id NOT IN ('click', 'view')"),
        _count_sql("unique", "ts", "SELECT count(*) FROM (SELECT ts FROM b GROUP BY ts HAVING count(*) > 1)"),
        _count_sql("relationships", "series_id", "SELECT count(*) FROM b WHERE series_id NOT IN "
                   "(SELECT event_type FROM events WHERE value > 489)"),
    ]
)


@query(
    "rules_by_day",
    f"""WITH b AS ({X.BARS}), r AS ({_STATE_SQL})
    SELECT *, CASE WHEN failed_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM r""",
)
def rules_by_day(spark, d):
    """Counted over wrong prices first; then some days change, and only these are counted again."""
    path, candles = scratch_folder(spark, "ruled"), X.pinned_candles(spark, d)
    parents = X.table(spark, d, "events").where("value > 489").select("event_type")
    own = (
        R.Check("close", "close_price < 250"),
        R.NotNull("thin"),
        R.AcceptedValues("series_id", ("click", "view")),
        R.Unique(("ts",)),
        R.References(("series_id",), parents, ("event_type",)),
    )
    index = DayIndex(spark, path)
    state = RuleState(index, own, derive=lambda df: df.withColumn("thin", F.when(F.minute("ts") % 10 != 0, 1)))
    changing = F.dayofmonth("ts") % 4 == 1
    tables.overwrite_days(candles.withColumn("close_price", F.when(changing, -1.0).otherwise(F.col("close_price"))), path)
    state.refresh()
    right = candles.where(changing)
    index.update(tables.days_of(right), lambda: tables.overwrite_days(right, path))
    return state.evaluate()


@query(
    "csv_history",
    f"""SELECT ts, round(open_price, 6) AS open_price, round(high_price, 6) AS high_price,
      round(low_price, 6) AS low_price, round(close_price, 6) AS close_price, round(volume, 6) AS volume,
      'btc' AS symbol, 'bitstamp' AS source
    FROM ({X.BARS}) WHERE series_id = 'click' AND ts < TIMESTAMP '2024-01-22'""",
)
def csv_history(spark, d):
    """Candles as a CSV of epoch seconds, read up to an exclusive time."""
    folder, rows = scratch_folder(spark, "csv"), X.pinned_candles(spark, d).where("series_id = 'click'")
    prices = ("open", "high", "low", "close")
    rows.select(
        F.unix_seconds("ts").alias("timestamp"), *[F.col(f"{c}_price").alias(c) for c in prices], "volume"
    ).write.csv(folder, header=True)
    read = tables.read_history_csv(spark, folder, cutoff=X.MARK)
    return read.withColumns({c: F.round(c, 6) for c in (*[f"{p}_price" for p in prices], "volume")})


@query("day_folders", f"SELECT series_id, ts, close_price FROM ({X.BARS})")
def day_folders(spark, d):
    """Days appended, and those of the second half replaced."""
    path, rows = scratch_folder(spark, "days"), X.pinned_candles(spark, d)
    late = F.col("ts") >= F.lit(X.MARK)
    tables.append_days(rows.where(~late), path)
    tables.append_days(rows.where(late).withColumn("close_price", F.lit(0.0)), path)
    tables.overwrite_days(rows.where(late), path)
    return spark.read.parquet(path).select("series_id", "ts", "close_price")
