"""Step results of a transformation run, as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import path_exists

RESULT = "struct<unique_id:string,status:string,execution_time:double,message:string>"
DOCUMENT = f"struct<results:array<{RESULT}>>"


def read_step_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per document; files that do not exist add no rows."""
    present = [p for p in paths if p and path_exists(spark, p)]
    if not present:
        return spark.createDataFrame([], "document string")
    return spark.read.text(present, wholetext=True).select(F.col("value").alias("document"))


def name_parts(unique_id: Column) -> tuple[Column, Column]:
    """Resource type and name of an id such as ``model.p.name`` or ``test.p.name.hash``."""
    parts = F.when(F.length(unique_id) > 0, F.split(unique_id, r"\."))
    kind = F.element_at(parts, 1)
    is_hashed = (kind == "test") & (F.size(parts) >= 3)
    return kind, F.when(is_hashed, F.try_element_at(parts, F.lit(-2))).otherwise(
        F.element_at(parts, -1)
    )


def parse_step_results(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row per step, next to the other columns of the input (for example run_id)."""
    rest = [c for c in documents.columns if c != document]
    results = F.from_json(document, DOCUMENT)["results"]
    steps = documents.select(*rest, F.explode(results).alias("_r"))
    kind, name = name_parts(F.col("_r.unique_id"))
    return steps.select(
        *rest,
        kind.alias("resource_type"),
        name.alias("model_name"),
        F.col("_r.status").alias("status"),
        F.col("_r.execution_time").alias("execution_time"),
        F.col("_r.message").alias("message"),
    )
