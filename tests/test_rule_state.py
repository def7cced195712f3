"""Rules counted by day equal the rules over the whole table."""

from datetime import date, timedelta

import pytest
from conftest import START
from pyspark.sql import functions as F

from wickwork.operators import rules
from wickwork.plans.days import DayIndex
from wickwork.plans.rule_state import RuleState
from wickwork.sources import tables

DAYS = 30


@pytest.fixture()
def lake(spark, make_candles, tmp_path):
    """Candles of some weeks with faults of every kind."""
    minutes = [d * 1440 + m for d in range(DAYS) for m in (0, 5, 700)]
    rows = make_candles(range(1, len(minutes) + 1), minutes).withColumn("version_id", F.lit("v1"))
    day = F.dayofmonth("ts")
    rows = rows.withColumns({
        "volume": F.when(day == 3, -1.0).when(day == 4, None).otherwise(F.col("volume")),
        "timeframe": F.when(day % 7 == 0, "5m").otherwise(F.col("timeframe")),
        "version_id": F.when(day == 9, "gone").when(day == 10, None).otherwise(F.col("version_id")),
    })
    rows = rows.unionByName(rows.where(day == 12)).unionByName(rows.where(day == 12).limit(1))
    path = str(tmp_path / "t")
    tables.overwrite_days(rows, path)
    return path


def rule_set(spark, *versions):
    parent = spark.createDataFrame([(v,) for v in versions], "id string")
    return (
        *rules.SILVER_RULES,
        *rules.CANDLE_CHECKS,
        rules.References(("version_id",), parent, ("id",)),
    )


def as_set(results):
    return sorted((r["rule"], r["column"], r["failed_rows"], r["status"]) for r in results.collect())


def whole(spark, path, own):
    return as_set(rules.evaluate(spark.read.parquet(path), list(own)))


def test_state_equals_the_whole_table_and_reads_changed_days_only(spark, lake):
    index, own = DayIndex(spark, lake), rule_set(spark, "v1")
    state = RuleState(index, own)
    assert as_set(state.evaluate()) == whole(spark, lake, own)
    assert state.refresh() == []
    changed = spark.read.parquet(lake).where(F.dayofmonth("ts") == 20).drop(tables.DAY)
    changed = changed.withColumn("high_price", F.lit(0.0))
    index.update([date(2024, 1, 20)], lambda: tables.overwrite_days(changed, lake))
    assert state.stale_days() == [date(2024, 1, 20)]
    plan = state.failures(state.stale_days())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ts_date" in plan or "PartitionFilters: [isnotnull(ts_date" in plan
    assert "2024-01-20" in plan or "19742" in plan
    assert as_set(state.evaluate()) == whole(spark, lake, own)
    assert ("check", "high_gte_low", 3, "fail") in as_set(state.evaluate())


def test_a_rewrite_of_equal_rows_changes_nothing(spark, lake):
    index = DayIndex(spark, lake)
    state = RuleState(index, rule_set(spark, "v1"))
    state.refresh()
    same = spark.read.parquet(lake).where(F.dayofmonth("ts") <= 2).drop(tables.DAY).repartition(3)
    index.update([date(2024, 1, 1), date(2024, 1, 2)], lambda: tables.overwrite_days(same, lake))
    assert state.stale_days() == []


def test_other_parents_rules_and_removed_days(spark, lake):
    index = DayIndex(spark, lake)
    RuleState(index, rule_set(spark, "v1")).refresh()
    # another parent changes the result without a recount
    own = rule_set(spark, "v1", "gone")
    state = RuleState(index, own)
    assert state.stale_days() == []
    assert as_set(state.evaluate()) == whole(spark, lake, own)
    # another rule counts all days again
    more = (*own, rules.Check("c", "close_price < 50"))
    state = RuleState(index, more)
    assert len(state.stale_days()) == DAYS
    assert as_set(state.evaluate()) == whole(spark, lake, more)
    # a removed day no longer counts
    gone = START.date() + timedelta(days=2)
    index.update([gone], lambda: tables.remove(spark, f"{lake}/{tables.DAY}={gone}"))
    assert as_set(state.evaluate()) == whole(spark, lake, more)


def test_sets_of_one_table_do_not_meet_and_empty_tables_pass(spark, lake, tmp_path):
    index = DayIndex(spark, lake)
    one = RuleState(index, tuple(rules.SILVER_RULES))
    two = RuleState(index, (rules.NotNull("twice"),), "twice", lambda df: df.withColumn("twice", F.nullif("volume", F.lit(1.0))))
    one.refresh()
    two.refresh()
    assert (one.stale_days(), two.stale_days()) == ([], [])
    assert two.evaluate().first()["failed_rows"] > 80
    with pytest.raises(ValueError, match="without a time"):
        RuleState(index, (rules.Unique(("symbol",)),))


def test_day_counts_without_a_digest_are_made_again(spark, lake):
    index = DayIndex(spark, lake)
    index.read()
    old = spark.read.parquet(f"{lake}_days").drop("digest").checkpoint()
    old.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(tables.DAY).parquet(f"{lake}_days")
    assert "digest" in index.read().columns
