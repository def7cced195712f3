"""Profiles and quality metrics of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import epoch_seconds
from ..session import broadcast_if_small, pinned


def _missing(df: DataFrame, name: str) -> Column:
    """1 for NULL, and for NaN in a floating-point column."""
    c = F.col(name)
    absent = c.isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(c)
    return absent.cast("int")


def _nulls_in_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    return reduce(lambda a, b: a + b, [_missing(df, c) for c in columns or df.columns])


def count_rows(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count(ts).alias("ts_count"))


def period_bounds(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("period_start"), F.max(ts).alias("period_end")).withColumns(
        {
            "start_epoch": epoch_seconds("period_start"),
            "end_epoch": epoch_seconds("period_end"),
        }
    )


def null_count(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(_nulls_in_row(df)), F.lit(0)).alias("null_count"))


FINGERPRINT = ["_low", "_high"]


def _with_fingerprint(df: DataFrame) -> DataFrame:
    """128 bits of each whole row; equal rows (NULLs, NaNs and zeros of any sign too) agree.

    Hashes pass over NULLs, so their places are hashed beside the values.
    """
    values = [F.col(c) for c in df.columns]
    places = F.concat(F.lit(""), *[F.when(v.isNull(), "1").otherwise("0") for v in values])
    low, high = F.xxhash64(*values, places), F.xxhash64(F.lit(1), places, *values)
    return df.withColumns(dict(zip(FINGERPRINT, (low, high))))


def repeated_rows(df: DataFrame) -> DataFrame:
    """Distinct rows that occur twice or more, with their copies; NULLs and NaNs equal themselves.

    Only fingerprints are shuffled for all rows, 24 bytes each whatever the columns. Whole rows
    move for those met twice, after copies are counted within each task, and these rows are
    compared in full, so rows whose fingerprints meet by chance stay apart.
    """
    marked = _with_fingerprint(df)
    met = marked.groupBy(*FINGERPRINT).agg(F.count(F.lit(1)).alias("_copies"))
    met = broadcast_if_small(pinned(met.where("_copies > 1").select(*FINGERPRINT)))
    rows = marked.join(met, FINGERPRINT, "left_semi").select(*df.columns)
    counted = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.where("_copies > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Surplus copies of whole rows."""
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return repeated_rows(df).agg(surplus.alias("duplicate_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def calendar_profile(
    df: DataFrame, unit: str, averages: dict[str, str], ts: str = "ts", digits: int = 2
) -> DataFrame:
    """Averages per month or year, in order; ``averages`` maps result name to column."""
    return (
        df.groupBy(F.date_trunc(unit, ts).alias(unit))
        .agg(*[F.round(F.avg(c), digits).alias(name) for name, c in averages.items()])
        .orderBy(unit)
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """Column names and types, with the NULL count of each column, in one pass."""
    fields = df.schema.fields
    counts = df.agg(
        *[F.coalesce(F.sum(_missing(df, f.name)), F.lit(0)).alias(f.name) for f in fields]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f.name).alias("null_count"),
            )
            for f in fields
        ]
    )
    return counts.select(F.inline(rows))


METRICS = [
    "row_count",
    "column_count",
    "null_count",
    "duplicate_count",
    "min_timestamp",
    "max_timestamp",
]


def quality_metrics(
    df: DataFrame, by: list[str] = (), ts: str | None = None, with_columns: int | None = None
) -> DataFrame:
    """Six metrics, one row per group (one row in all without ``by``).

    Counts, NULLs and bounds are partial sums, duplicates come from fingerprints
    (``repeated_rows``), so no shuffle carries all columns of all rows.
    """
    by = list(by)
    body = [c for c in df.columns if c not in by]
    ts = ts or ("timestamp" if "timestamp" in body else "open_time")
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(_nulls_in_row(df, body)).alias("_nulls"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
    )
    surplus = repeated_rows(df).groupBy(*by).agg(F.sum(F.col("_copies") - 1).alias("_surplus"))

    def total(name: str, alias: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("double").alias(alias)

    # A group may be NULL, which a join would lose.
    return (
        counted.unionByName(surplus, allowMissingColumns=True)
        .groupBy(*by)
        .agg(
            total("_rows", "row_count"),
            F.lit(float(with_columns or len(body))).alias("column_count"),
            total("_nulls", "null_count"),
            total("_surplus", "duplicate_count"),
            epoch_seconds(F.min("_first")).alias("min_timestamp"),
            epoch_seconds(F.max("_last")).alias("max_timestamp"),
        )
    )


def in_long_form(metrics: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows of (metric_name, metric_value)."""
    return metrics.unpivot(list(by), METRICS, "metric_name", "metric_value")


EXPECTED_ROWS_WEEKLY = 7 * 24 * 60


def coverage(metrics: DataFrame, expected_rows: int = EXPECTED_ROWS_WEEKLY) -> DataFrame:
    """Share of the expected candles and the span, from the metrics of a batch."""
    rows = F.col("row_count")
    percent = F.least(F.lit(100.0), rows / F.lit(expected_rows) * 100)
    hours = (F.col("max_timestamp") - F.col("min_timestamp")) / 3600
    return metrics.withColumns(
        {
            "coverage_pct": F.when(rows > 0, percent),
            "span_hours": hours,
            "span_days": hours / 24,
        }
    )
