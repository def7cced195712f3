"""Incremental runner: new bronze files to silver and the marts.

Structured Streaming only tracks which files are new.  Each batch is upserted into
silver by day and the same batch functions then extend the marts, so a stream and a
batch run give the same tables.  A batch that is replayed after a failure changes
nothing: the upsert is keyed and the marts take rows after their marks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..operators.candles import latest_silver, silver
from ..plans.days import DayIndex
from ..plans.weekly import Lake, run_increment
from ..schema import BRONZE
from ..session import pinned, prepare
from ..sources import tables

SILVER_KEY = ["series_id", "ts"]


def merge_batch(spark: SparkSession, lake: Lake, bronze: DataFrame, settings: Settings) -> int:
    """Upsert one batch of bronze rows; an older extraction never replaces a newer one."""
    fresh = pinned(silver(bronze, settings.series_by_symbol))
    rows = fresh.count()
    if not rows:
        return 0
    days = tables.days_of(fresh)
    if tables.table_exists(spark, lake.silver):
        # the days prune folders; a stored row competes with the batch by the same rule
        stored = spark.read.parquet(lake.silver).where(F.col(tables.DAY).isin(days)).drop(tables.DAY)
        names = [F.col(k).alias(f"_{k}") for k in SILVER_KEY]
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in SILVER_KEY]
        rivals = stored.join(fresh.select(*names).distinct(), same[0] & same[1], "left_semi")
        fresh = pinned(latest_silver(fresh.unionByName(rivals)))

    def write() -> None:
        tables.upsert_days(spark, lake.silver, fresh, SILVER_KEY, [F.col("ingested_at").desc()])

    index = DayIndex(spark, lake.silver)
    index.read()
    index.update(days, write)
    return rows


def run_available(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    files_per_batch: int | None = None,
    as_of=None,
) -> None:
    """Process every bronze file that has not been seen, then stop.

    ``checkpoint`` is a folder on shared storage that belongs to this stream.
    """
    prepare(spark)
    lake = Lake(root)
    reader = spark.readStream.schema(BRONZE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if merge_batch(session, lake, batch, settings):
            run_increment(session, lake, settings, as_of)

    query = (
        reader.parquet(lake.bronze)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
