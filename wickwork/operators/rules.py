"""Declarative data-quality rules.

``evaluate`` turns a list of rules into rows (rule, column, failed_rows, status).
All row-local rules of a table share one aggregation; each uniqueness or
referential rule adds one shuffle of its key columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import alert
from ..schema import SIGNALS, TIMEFRAMES
from .keys import duplicate_keys, fk_violations
from .profile import coverage


@dataclass(frozen=True)
class NotNull:
    column: str
    rule = "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """NULL passes."""

    column: str
    values: tuple
    rule = "accepted_values"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Check:
    """A SQL condition; NULL passes, as in a CHECK constraint."""

    column: str
    condition: str
    rule = "check"

    def fails(self) -> Column:
        return ~F.expr(self.condition)


@dataclass(frozen=True)
class IsTrue:
    """A SQL condition that must hold; NULL passes, because NOT NULL is not true."""

    column: str
    condition: str
    rule = "expression_is_true"

    def fails(self) -> Column:
        return ~F.expr(self.condition)


@dataclass(frozen=True)
class Unique:
    """Keys that occur twice or more; keys with a NULL are left out."""

    columns: tuple[str, ...]
    where: str | None = None
    rule = "unique"

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def count(self, df: DataFrame) -> DataFrame:
        rows = df.where(self.where) if self.where else df
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])
        repeated = duplicate_keys(rows.where(whole), list(self.columns))
        return repeated.agg(F.count(F.lit(1)).alias("failed_rows"))


@dataclass(frozen=True)
class References:
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]
    rule = "relationships"

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def count(self, df: DataFrame) -> DataFrame:
        orphans = fk_violations(df, self.parent, dict(zip(self.columns, self.parent_columns)))
        return orphans.agg(F.count(F.lit(1)).alias("failed_rows"))


def evaluate(df: DataFrame, rules: list) -> DataFrame:
    local = [r for r in rules if hasattr(r, "fails")]
    results = []
    if local:
        counts = df.agg(*[F.count_if(r.fails()).alias(f"_{i}") for i, r in enumerate(local)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(r.rule).alias("rule"),
                    F.lit(r.column).alias("column"),
                    F.col(f"_{i}").alias("failed_rows"),
                )
                for i, r in enumerate(local)
            ]
        )
        results.append(counts.select(F.inline(rows)))
    for r in rules:
        if not hasattr(r, "fails"):
            labels = [F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column")]
            results.append(r.count(df).select(*labels, "failed_rows"))
    if not results:
        raise ValueError("no rules given")
    return with_status(reduce(DataFrame.unionByName, results))


def with_status(results: DataFrame) -> DataFrame:
    status = F.when(F.col("failed_rows") == 0, "pass").otherwise("fail")
    return results.withColumn("status", status)


# The rules of each table.
BRONZE_RULES = [
    NotNull("open_time"),
    NotNull("close"),
    NotNull("volume"),
    NotNull("symbol"),
    Unique(("symbol", "open_time")),
]
SILVER_RULES = [
    *[
        NotNull(c)
        for c in (
            "ts",
            "symbol",
            "timeframe",
            "open_price",
            "high_price",
            "low_price",
            "close_price",
            "volume",
            "source",
        )
    ],
    AcceptedValues("timeframe", ("1m",)),
    IsTrue("high_price", "high_price >= low_price"),
    IsTrue("open_price", "open_price >= 0 AND close_price >= 0"),
    IsTrue("volume", "volume >= 0"),
    Unique(("series_id", "ts")),
]
RETURNS_RULES = [
    NotNull("ts"),
    NotNull("close_price"),
    NotNull("log_volume"),
    Unique(("series_id", "ts")),
]
SIGNAL_RULES = [AcceptedValues(c, (0, 1)) for c in SIGNALS[:3]]
FEATURE_RULES = [
    NotNull("ts"),
    NotNull("source"),
    *SIGNAL_RULES,
    Unique(("series_id", "ts", "version_id")),
]
LABEL_RULES = [
    NotNull("ts"),
    NotNull("y_logret_5m"),
    NotNull("y_logret_15m"),
    NotNull("y_shock_15m"),
    AcceptedValues("y_shock_15m", (0, 1)),
    Unique(("series_id", "ts", "version_id")),
]
CANDLE_CHECKS = [
    Check("high_gte_low", "high_price >= low_price"),
    Check("high_gte_open", "high_price >= open_price"),
    Check("high_gte_close", "high_price >= close_price"),
    Check("low_lte_open", "low_price <= open_price"),
    Check("low_lte_close", "low_price <= close_price"),
    Check("volume_pos", "volume >= 0"),
    AcceptedValues("timeframe", tuple(TIMEFRAMES)),
]
CHECKPOINT_RULES = [AcceptedValues("status", ("ok", "error")), NotNull("last_ts")]
VERSION_RULES = [
    NotNull("version_id"),
    NotNull("is_active"),
    Unique(("version_id",)),
    Unique(("is_active",), where="is_active"),
]


def batch_checks(
    metrics: DataFrame,
    by: list[str] = (),
    null_levels: tuple[int, int] = (5, 50),
    duplicate_levels: tuple[int, int] = (1, 10),
) -> DataFrame:
    """Five checks per batch as ok / warn / fail, with alert colours for the counts."""
    measured = coverage(metrics)
    share = F.coalesce(F.col("coverage_pct"), F.lit(0.0))
    nulls, copies = F.col("null_count"), F.col("duplicate_count")
    rows, width = F.col("row_count"), F.col("column_count")
    checks = [
        ("nulls", nulls, nulls == 0, nulls < null_levels[0], alert(nulls, *null_levels)),
        ("duplicates", copies, copies == 0, copies < duplicate_levels[0],
         alert(copies, *duplicate_levels)),
        ("volume", rows, rows > 1000, rows > 100, F.lit(None).cast("string")),
        ("schema", width, width >= 5, width >= 4, F.lit(None).cast("string")),
        ("coverage", share, share >= 95, share >= 80, F.lit(None).cast("string")),
    ]
    rows_of = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                value.alias("check_value"),
                F.when(good, "ok").when(fair, "warn").otherwise("fail").alias("check_status"),
                colour.alias("alert"),
            )
            for name, value, good, fair, colour in checks
        ]
    )
    return measured.select(*by, F.inline(rows_of))
