"""Parquet and CSV tables of the lake."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import week_label, week_start
from ..operators.candles import before_cutoff, in_window
from ..operators.keys import upsert
from ..schema import BRONZE, HISTORY_CSV, INTERVAL, NUMBERS

WEEK = "week_start"
BATCH = "batch"
DAY = "ts_date"
VERSION = "of_version"


def read_bronze(
    spark: SparkSession, *paths: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Bronze candles by declared schema; several folders are read as one table.

    With bounds only the week folders that can hold candles of [start, end) are read.
    """
    stored = spark.read.schema(BRONZE).parquet(*paths)
    if start is not None:
        stored = stored.where(F.col(WEEK) >= start.date() - timedelta(days=6))
    if end is not None:
        stored = stored.where(F.col(WEEK) <= end.date())
    candles = stored.select(*BRONZE.names)
    return candles if start is None or end is None else in_window(candles, start, end)


def read_batch(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """The stored rows of one batch."""
    stored = spark.read.parquet(path)
    return stored.where(F.col(BATCH).cast("string") == batch).select(*BRONZE.names)


def bronze_union(*frames: DataFrame) -> DataFrame:
    """History and weekly candles together; silver removes the overlap."""
    return reduce(DataFrame.unionByName, [f.select(*BRONZE.names) for f in frames])


def write_bronze(candles: DataFrame, path: str, batch: str | None = None) -> None:
    """Snappy Parquet in folders per week and batch.

    ``batch`` labels the extraction (the first day of its window); by default it is
    the week.  A rerun of a batch replaces that batch, other batches stay.
    """
    label = F.lit(batch) if batch else week_label("open_time")
    (
        candles.select(*BRONZE.names)
        .withColumns({WEEK: F.to_date(week_start("open_time")), BATCH: label})
        .hint("rebalance", F.col(WEEK))
        .sortWithinPartitions("open_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(WEEK, BATCH)
        .parquet(path)
    )


def read_history_csv(
    spark: SparkSession, path: str, symbol: str = "btc", source: str = "bitstamp", cutoff=None
) -> DataFrame:
    """Historical CSV with epoch seconds, renamed, up to an exclusive cut-off time."""
    names = {c: f"{c}_price" for c in NUMBERS if c != "volume"} | {"volume": "volume"}
    rows = spark.read.schema(HISTORY_CSV).csv(path, header=True).select(
        F.timestamp_seconds("timestamp").alias("ts"),
        *[F.col(c).alias(n) for c, n in names.items()],
        F.lit(symbol).alias("symbol"),
        F.lit(source).alias("source"),
    )
    return rows if cutoff is None else before_cutoff(rows, cutoff)


def history_as_bronze(history: DataFrame, extracted_at) -> DataFrame:
    """The CSV history in bronze layout."""
    return history.select(
        F.col("ts").alias("open_time"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("close_time"),
        *[F.col(f"{c}_price" if c != "volume" else c).alias(c) for c in NUMBERS],
        "symbol",
        F.lit(INTERVAL).alias("interval"),
        "source",
        F.lit(extracted_at).cast("timestamp").alias("extracted_at"),
    )


def by_day(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows arranged for day folders: AQE splits large days and joins small ones."""
    return (
        df.withColumn(DAY, F.to_date(ts))
        .hint("rebalance", F.col(DAY))
        .sortWithinPartitions("series_id", ts)
    )


def append_days(df: DataFrame, path: str) -> None:
    by_day(df).write.mode("append").partitionBy(DAY).parquet(path)


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replace exactly the days present in ``df``."""
    (
        by_day(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def version_folder(version: str) -> str:
    """Folder value of a version: its bytes in hex, the same for any spelling."""
    return "v" + version.encode().hex().upper()


def append_versions(df: DataFrame, path: str) -> None:
    """Append to a mart: folders per version and day."""
    folder = F.concat(F.lit("v"), F.hex(F.col("version_id").cast("binary")))
    by_day(df).withColumn(VERSION, folder).write.mode("append").partitionBy(VERSION, DAY).parquet(path)


def replace_version(df: DataFrame, path: str, version: str) -> None:
    """Replace all rows of one version of a mart; other versions stay."""
    (
        by_day(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(DAY)
        .parquet(f"{path}/{VERSION}={version_folder(version)}")
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole unpartitioned table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data, not only markers of an unfinished write."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        inside = files.next().getPath().toString().split(target.getName(), 1)[-1]
        if not any(part.startswith(("_", ".")) for part in inside.split("/")):
            return True
    return False


def days_of(df: DataFrame, ts: str = "ts") -> list:
    """The days of a table's rows; their number is bounded by the calendar."""
    days = df.select(F.to_date(ts).alias(DAY)).distinct()
    return sorted(r[0] for r in days.where(F.col(DAY).isNotNull()).collect())


def upsert_days(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order=None) -> None:
    """Upsert into a day-partitioned table, rewriting only the days ``new`` touches.

    Dynamic overwrite stages the new files and swaps the touched day folders when the
    job commits, so reading those days in the same plan is safe; ``new`` should be a
    written or pinned table, as it is read three times.
    """
    if table_exists(spark, path):
        # the days, bounded by the calendar, prune folders at planning time
        old = spark.read.parquet(path).where(F.col(DAY).isin(days_of(new))).drop(DAY)
    else:
        old = new.limit(0)
    overwrite_days(upsert(old, new, keys, order).select(*new.columns), path)
