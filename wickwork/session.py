"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table is held by the driver and every executor, so both bounds hold.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def get_spark(app: str = "wickwork", master: str | None = None, **conf) -> SparkSession:
    """A session whose checkpoints are removed once no DataFrame needs them."""
    builder = SparkSession.builder.appName(app).config(
        "spark.cleaner.referenceTracking.cleanCheckpoints", "true"
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Candle times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a single local process gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="wickwork-")
    context.setCheckpointDir(shared)


def pinned(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: survives lost executors, computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None
) -> DataFrame:
    """Broadcast hint behind a check of rows and bytes; a larger table is shuffled.

    ``df`` must be cheap to read, so pass a pinned or written table; ``rows`` saves the
    count of a table without texts if they are known.
    """
    if rows is not None and rows > max_rows:
        return df
    fixed, sized = _row_bytes(df)
    if rows is None or sized:
        texts = [F.coalesce(F.sum(s), F.lit(0)) for s in sized]
        rows, *used = df.limit(max_rows + 1).agg(F.count(F.lit(1)), *texts).first()
    else:
        used = []
    small = rows <= max_rows and rows * fixed + sum(used) <= BROADCAST_BYTES
    return F.broadcast(df) if small else df


def _row_bytes(df: DataFrame):
    """Bytes of a row that its types fix, and expressions for those that values decide."""
    sized = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sized.append(F.octet_length(F.col(f"`{f.name}`")))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sized.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
    return 16 + 8 * len(df.columns), sized


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a written intermediate table, next to the checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
