"""One row per key.

``row_number() = 1`` lets Spark keep at most one row per key and task before the
shuffle (WindowGroupLimit), so a key with very many copies does not reach one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_latest(
    df: DataFrame, keys: list[str], latest: str, tiebreak: list[str] = ()
) -> DataFrame:
    """The row with the greatest ``latest`` per key; ties go by ``tiebreak`` ascending."""
    return _first_by(df, keys, [F.col(latest).desc(), *[F.col(c).asc() for c in tiebreak]])


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row per key, ascending."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return _first_by(df, keys, [c.asc() for c in columns])
