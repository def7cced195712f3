"""Physical plans: what is pushed down, pre-aggregated and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from wickwork.catalog import QUERIES
from wickwork.operators import keys as K
from wickwork.operators.candles import silver
from wickwork.operators.profile import quality_metrics
from wickwork.operators.validate import validate_batches
from wickwork.plans.monitoring import recent_runs, top_results
from wickwork.schema import BRONZE
from wickwork.sources import tables


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.createDataFrame([], BRONZE).write.parquet(path)
    return spark.read.schema(BRONZE).parquet(path)


def test_silver_filters_reach_the_scan_and_copies_are_cut_early(bronze):
    plan = physical(silver(bronze))
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f"IsNotNull({c})" in pushed for c in ("open_time", "close", "high", "low"))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_scan_reads_only_needed_columns(bronze):
    plan = physical(quality_metrics(bronze.select("open_time", "close")))
    assert "ReadSchema: struct<open_time:timestamp,close:double>" in plan


def test_validation_pre_aggregates(bronze):
    df = bronze.withColumns({"a": F.lit("2024-01-01").cast("timestamp"), "b": F.lit("2024-01-08").cast("timestamp")})
    plan = physical(validate_batches(df, ["source"], "a", "b"))
    assert "partial_count" in plan and "partial_sum" in plan


def test_top_lists_do_not_sort_the_table(spark):
    steps = spark.createDataFrame([], "resource_type string, model_name string, status string")
    assert "WindowGroupLimit" in physical(top_results(steps))
    runs = spark.createDataFrame(
        [], "run_id string, status string, started_at timestamp, duration_seconds double,"
        "rows_extracted bigint, rows_loaded bigint")
    assert "TakeOrderedAndProject" in physical(recent_runs(runs))


def test_orphans_are_found_on_keys_only(spark):
    child = spark.createDataFrame([(1, "a"), (9, "b")], "k int, wide string")
    plan = physical(K.fk_violations(child, spark.createDataFrame([(1,)], "k int"), ["k"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_day_folders_are_pruned(spark, make_candles, tmp_path):
    path = str(tmp_path / "t")
    tables.append_days(make_candles([1, 2], minutes=[0, 1440]), path)
    one = spark.read.parquet(path).where(F.col(tables.DAY) >= F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(ts_date" in physical(one)
    assert one.count() == 1


def test_window_queries_pin_only_what_they_need(spark):
    plan = physical(QUERIES["rolling_std"](spark, "/root/testdata/sf0.001"))
    scanned = re.search(r"Scan ExistingRDD\[([^\]]*)\]", plan).group(1)
    assert [c.split("#")[0] for c in scanned.split(",")] == ["series_id", "ts", "close_price"]
