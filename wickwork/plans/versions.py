"""The registry of feature versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, VERSION_DESCRIPTION, VERSION_ID, VERSION_TAG


def feature_versions(spark: SparkSession, as_of: datetime | None = None) -> DataFrame:
    """The one-row version table; it is replaced as a whole on each run."""
    created = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return spark.range(1).select(
        F.lit(VERSION_ID).alias("version_id"),
        F.lit(True).alias("is_active"),
        created.alias("created_at"),
    )


def version_registry(spark: SparkSession, as_of: datetime | None = None) -> DataFrame:
    """The full registry row: description, list of features, deprecation."""
    return feature_versions(spark, as_of).select(
        "version_id",
        F.lit(VERSION_TAG).alias("version_tag"),
        F.lit(VERSION_DESCRIPTION).alias("description"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("features_list"),
        "is_active",
        "created_at",
        F.lit(None).cast("timestamp").alias("deprecated_at"),
    )
