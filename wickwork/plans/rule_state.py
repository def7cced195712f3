"""Quality rules of a growing table, kept as counts per day and rule.

Row-local rules add up over days. A key that holds the time lies within one day, so repeated
keys add up as well. A reference is kept as rows per referenced key and met with its parent
when the result is read, so a later parent needs no recount. Only days whose content has
changed since they were counted, by the digest in the table's day counts, are read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rules import References, Unique, with_status
from ..session import pinned
from ..sources import tables
from ..sources.tables import DAY
from .days import DayIndex

LAYOUT = f"spec string, key string, failed bigint, rows bigint, digest decimal(38,0), {DAY} date"


def rule_spec(rule) -> str:
    """What a rule tests, as text; the parent of a reference is not part of it."""
    if isinstance(rule, References):
        return f"{rule.rule}: {rule.column}"
    return repr(rule)


def _key(columns) -> Column:
    """A key as text, its parts by position."""
    parts = [F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(columns)]
    return F.to_json(F.struct(*parts))


def _complete(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


@dataclass(frozen=True)
class RuleState:
    """The rules of the table of ``index``; ``derive`` adds columns that they need.

    Unique keys must hold ``ts``.  Several sets of rules of one table differ by ``name``.
    """

    index: DayIndex
    rules: tuple
    name: str = "rules"
    derive: Callable[[DataFrame], DataFrame] = lambda df: df

    def __post_init__(self):
        wrong = [r.column for r in self.rules if isinstance(r, Unique) and "ts" not in r.columns]
        if wrong:
            raise ValueError(f"unique keys without a time cannot be counted by day: {wrong}")

    @property
    def path(self) -> str:
        return f"{self.index.path}_{self.name}"

    @property
    def _marker(self) -> str:
        """Stands once per counted day; another set of rules has another one."""
        return "all: " + "; ".join(rule_spec(r) for r in self.rules)

    def _stored(self) -> DataFrame | None:
        spark = self.index.spark
        if not tables.table_exists(spark, self.path):
            return None
        return spark.read.schema(LAYOUT).parquet(self.path)

    def stale_days(self) -> list[date]:
        """Days that have changed since they were counted, or were counted with other rules."""
        days = self._days()
        stored = self._stored()
        if stored is None:
            return sorted(r[0] for r in days.select(DAY).collect())
        seen = stored.where(F.col("spec") == self._marker)
        same = [DAY, "rows", "digest"]
        # one row per day of the calendar
        return sorted(r[0] for r in days.join(seen.select(*same), same, "left_anti").select(DAY).collect())

    def _days(self) -> DataFrame:
        counts = self.index.read()
        return counts.where(F.col(DAY).isNotNull()).groupBy(DAY).agg(
            F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest")
        )

    def refresh(self) -> list[date]:
        """Count the stale days; returns them."""
        spark, stale = self.index.spark, self.stale_days()
        if stale:
            days = self._days().where(F.col(DAY).isin(stale))
            counted = self.failures(stale)
            marks = days.select(DAY, F.lit(self._marker).alias("spec"), F.lit(None).cast("string").alias("key"),
                                F.lit(0).cast("bigint").alias("failed"))
            rows = marks.unionByName(counted).join(days, DAY)
            (
                rows.select("spec", "key", "failed", "rows", "digest", DAY)
                .hint("rebalance", F.col(DAY))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(DAY)
                .parquet(self.path)
            )
        stored = self._stored()
        if stored is not None:
            gone = stored.select(DAY).distinct().join(self._days(), DAY, "left_anti")
            for (day,) in gone.collect():
                tables.remove(spark, f"{self.path}/{DAY}={day:%Y-%m-%d}")
        return stale

    def failures(self, days: list[date]) -> DataFrame:
        """(day, spec, key, failed) of some days, read from the table."""
        table = self.index.spark.read.parquet(self.index.path)
        rows = self.derive(table.where(F.col(DAY).isin(days)))
        none = F.lit(None).cast("string").alias("key")
        out = []
        local = [r for r in self.rules if hasattr(r, "fails")]
        if local:
            counts = rows.groupBy(DAY).agg(*[F.count_if(r.fails()).alias(f"_{i}") for i, r in enumerate(local)])
            each = F.array(
                *[F.struct(F.lit(rule_spec(r)).alias("spec"), F.col(f"_{i}").alias("failed")) for i, r in enumerate(local)]
            )
            found = counts.select(DAY, F.inline(each))
            out.append(found.where("failed > 0").select(DAY, "spec", none, "failed"))
        for r in self.rules:
            if hasattr(r, "fails"):
                continue
            spec = F.lit(rule_spec(r)).alias("spec")
            own = rows.where(r.where) if isinstance(r, Unique) and r.where else rows
            keys = own.where(_complete(r.columns)).groupBy(DAY, *r.columns).agg(F.count(F.lit(1)).alias("failed"))
            if isinstance(r, Unique):
                keys = keys.where("failed > 1").groupBy(DAY).agg(F.count(F.lit(1)).alias("failed"))
                out.append(keys.select(DAY, spec, none, "failed"))
            else:
                out.append(keys.select(DAY, spec, _key(r.columns).alias("key"), "failed"))
        return reduce(DataFrame.unionByName, out)

    def evaluate(self) -> DataFrame:
        """Refresh, then the same rows as ``rules.evaluate`` over the whole table."""
        self.refresh()
        spark, stored = self.index.spark, self._stored()
        labels = spark.createDataFrame(
            [(i, rule_spec(r), r.rule, r.column) for i, r in enumerate(self.rules)],
            "place int, spec string, rule string, column string",
        ).coalesce(1)
        if stored is None:
            counts = spark.createDataFrame([], "spec string, failed bigint")
        else:
            stored = pinned(stored.where(F.col("spec") != self._marker))
            parts = [stored.where("key IS NULL").select("spec", "failed")]
            for r in self.rules:
                if isinstance(r, References):
                    parents = r.parent.where(_complete(r.parent_columns))
                    parents = parents.select(_key(r.parent_columns).alias("key")).distinct()
                    own = stored.where((F.col("spec") == rule_spec(r)) & F.col("key").isNotNull())
                    own = own.groupBy("spec", "key").agg(F.sum("failed").alias("failed"))
                    parts.append(own.join(parents, "key", "left_anti").select("spec", "failed"))
            counts = reduce(DataFrame.unionByName, parts)
        sums = counts.groupBy("spec").agg(F.sum("failed").alias("failed"))
        found = labels.join(sums, "spec", "left").orderBy("place")
        failed = F.coalesce("failed", F.lit(0)).alias("failed_rows")
        return with_status(found.select("rule", "column", failed))
