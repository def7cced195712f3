"""Key constraints, profiles, rules and monitoring figures."""

from datetime import datetime, timezone

import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from wickwork.operators import keys as K
from wickwork.operators import profile as P
from wickwork.operators import rules as R
from wickwork.plans import monitoring as M
from wickwork.plans.versions import feature_versions, version_registry
from wickwork.schema import FEATURES
from wickwork.session import BROADCAST_ROWS, broadcast_if_small

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)


def table(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_insert_ignore(spark):
    old = table(spark, [(1, "a"), (1, "a")])
    new = table(spark, [(1, "x"), (2, "z"), (2, "y")])
    assert [tuple(r) for r in K.insert_ignore(old, new, ["k"]).collect()] == [(2, "y")]


def test_upsert(spark):
    old = table(spark, [(1, "a"), (2, "b"), (None, "n")])
    new = table(spark, [(2, "y"), (2, "z"), (3, "c")])
    got = K.upsert(old, new, ["k"], [F.col("v").desc()])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (2, "z"), (3, "c"), (None, "n")]


def test_fk_ignores_incomplete_keys(spark):
    child = table(spark, [(1, "a"), (9, "b"), (None, "c")])
    parent = table(spark, [(1, "p"), (1, "q")], "id int, w string")
    assert [r["v"] for r in K.fk_violations(child, parent, {"k": "id"}).collect()] == ["b"]


def test_active_version(spark):
    df = table(spark, [(1, "a")])
    tagged = K.cross_active_version(df, feature_versions(spark, AS_OF))
    assert tagged.first()["version_id"] == "v1"
    retired = feature_versions(spark, AS_OF).withColumn("is_active", F.lit(False))
    assert K.cross_active_version(df, retired).count() == 0
    with pytest.raises(RuntimeError, match="No active version"):
        K.cross_active_version(df, retired, strict=True)
    (row,) = version_registry(spark, AS_OF).collect()
    assert row["features_list"] == FEATURES and row["deprecated_at"] is None


def test_duplicates_treat_nulls_as_equal(spark):
    df = table(spark, [(1, None), (1, None), (2, "x")])
    assert P.duplicate_rows(df).first()[0] == 1
    nan = table(spark, [(1, float("nan")), (1, float("nan")), (2, None)], "k int, x double")
    assert P.duplicate_rows(nan).first()[0] == 1
    assert P.null_count(nan).first()[0] == 3


def test_quality_metrics(spark):
    data = [(START, 1.0), (START, 1.0), (START, None)]
    df = table(spark, data, "open_time timestamp, close double")
    (row,) = P.quality_metrics(df).collect()
    assert row.asDict() == {
        "row_count": 3.0, "column_count": 2.0, "null_count": 1.0, "duplicate_count": 1.0,
        "min_timestamp": 1704067200.0, "max_timestamp": 1704067200.0,
    }
    assert P.in_long_form(P.quality_metrics(df)).count() == 6
    (row,) = P.coverage(P.quality_metrics(df.limit(0))).collect()
    assert row["row_count"] == 0 and row["coverage_pct"] is None
    renamed = df.withColumnRenamed("open_time", "timestamp")
    assert P.quality_metrics(renamed).first()["min_timestamp"] == 1704067200.0


def test_rules(spark):
    df = table(spark, [(1, 2.0, "1m"), (1, None, "1m"), (None, -1.0, "2m")], "k int, x double, tf string")
    parent = table(spark, [(1,)], "id int")
    rules = [
        R.NotNull("x"), R.AcceptedValues("tf", ("1m",)), R.Check("pos", "x >= 0"), R.IsTrue("x", "x >= 0"),
        R.Unique(("k",)), R.References(("k",), parent, ("id",)),
    ]
    got = {(r["rule"], r["column"]): (r["failed_rows"], r["status"]) for r in R.evaluate(df, rules).collect()}
    assert got == {
        ("not_null", "x"): (1, "fail"), ("accepted_values", "tf"): (1, "fail"), ("check", "pos"): (1, "fail"),
        ("expression_is_true", "x"): (1, "fail"), ("unique", "k"): (1, "fail"), ("relationships", "k"): (0, "pass"),
    }


def test_row_local_rules_share_one_aggregation(spark):
    df = table(spark, [(1, "a")])
    plan = R.evaluate(df, [R.NotNull("k"), R.NotNull("v")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_batch_checks_demo_batch(spark):
    metrics = spark.createDataFrame(
        [(10080.0, 6.0, 4.0, 0.0, 1745107200.0, 1745712000.0)], P.METRICS
    )
    got = {r["check_name"]: (r["check_status"], r["alert"]) for r in R.batch_checks(metrics).collect()}
    assert got == {
        "nulls": ("warn", "green"), "duplicates": ("ok", "green"), "volume": ("ok", None),
        "schema": ("ok", None), "coverage": ("ok", None),
    }
    (c,) = P.coverage(metrics).collect()
    assert (c["coverage_pct"], c["span_hours"], c["span_days"]) == (100.0, 168.0, 7.0)


def runs(spark):
    data = [
        (f"run-{i:03d}", "success" if i % 6 else "Failed", datetime(2025, 4, 28 - i, 8), 245.0 + i * 8, 10080, 10080)
        for i in range(14)
    ]
    return spark.createDataFrame(
        data, "run_id string, status string, started_at timestamp, duration_seconds double, rows_extracted bigint, rows_loaded bigint"
    )


def test_run_figures(spark):
    (k,) = M.run_kpis(runs(spark)).collect()
    assert (k["total_runs"], k["success_runs"], k["failed_runs"], k["success_rate"]) == (14, 11, 3, 79)
    assert (k["mean_duration"], k["max_duration"], k["rate_colour"]) == (297.0, 349.0, "amber")
    (empty,) = M.run_kpis(runs(spark).limit(0)).collect()
    assert (empty["total_runs"], empty["success_rate"]) == (0, 0)
    days = rows(M.runs_per_day(runs(spark)), "day")
    assert [d["day_label"] for d in days][:2] == ["Apr 15", "Apr 16"]
    assert sum(d["success"] for d in days) == 11 and sum(d["failed"] for d in days) == 3
    assert [r["run_id"] for r in M.recent_runs(runs(spark), 2).collect()] == ["run-000", "run-001"]


def test_load_integrity(spark):
    df = spark.createDataFrame([(100, 97), (None, 5), (0, 0), (100, 50)], "rows_extracted int, rows_loaded int")
    got = [(r["integrity_pct"], r["integrity_tier"]) for r in M.with_load_integrity(df).collect()]
    assert got == [(97.0, "amber"), (100.0, "green"), (100.0, "green"), (50.0, "red")]


def steps(spark, n=12):
    kinds = ["model", "test", "seed"]
    data = [("r1", kinds[i % 3], f"n{i:02d}", ["PASS", "fail", None][i % 3], float(i), None) for i in range(n)]
    return spark.createDataFrame(
        data, "run_id string, resource_type string, model_name string, status string, execution_time double, message string"
    )


def test_step_figures(spark):
    clean = M.with_normal_status(steps(spark))
    assert {r[0] for r in clean.select("status").distinct().collect()} == {"success", "error", ""}
    (k,) = M.step_kpis(clean).collect()
    assert (k["total"], k["success"], k["errors"], k["models"], k["tests"], k["total_time"]) == (12, 4, 4, 4, 4, 66.0)
    top = M.top_results(steps(spark, 30))
    assert {r["result_group"]: r["n"] for r in top.groupBy("result_group").agg(F.count("*").alias("n")).collect()} == {
        "model": 5, "test": 5, "other": 5}
    assert [r["execution_time"] for r in M.step_times(steps(spark)).collect()] == [3.0, 6.0, 9.0]
    assert M.filter_results(clean, ["test"], ["error"]).count() == 4


def test_snapshot_has_one_shape_for_every_run(spark, tmp_path):
    metrics = spark.createDataFrame(
        [("r1", "row_count", 3.0, START), ("r1", "row_count", 5.0, AS_OF), ("gone", "row_count", 1.0, START)],
        "run_id string, metric_name string, metric_value double, created_at timestamp",
    )
    log = spark.createDataFrame(
        [("r1", "success", START, 1.0, 3, 3), ("r2", "failed", START, 1.0, 0, 0)],
        "run_id string, status string, started_at timestamp, duration_seconds double, rows_extracted bigint, rows_loaded bigint",
    )
    both = steps(spark, 50).unionByName(steps(spark, 2).withColumn("run_id", F.lit("gone")))
    M.write_snapshot(M.monitoring_snapshot(log, both, metrics, F.lit(AS_OF)), str(tmp_path / "s"))
    back = spark.read.json(str(tmp_path / "s"))
    counts = {(r["run_id"], r["kind"]): r["count"] for r in back.groupBy("run_id", "kind").count().collect()}
    assert counts == {
        ("r1", "run"): 1, ("r2", "run"): 1, ("r1", "step"): 50, ("gone", "step"): 2, ("r1", "metric"): 1, ("gone", "metric"): 1}
    assert back.where("kind = 'step' AND run_id = 'r1'").select("dbt.model_name").distinct().count() == 50
    assert back.where("run_id = 'r1'").agg(F.max("quality.metric_value")).first()[0] == 5.0
    assert back.where("exported_at IS NULL").count() == 0
    assert back.where("coalesce(pipeline._fetched_at, dbt._fetched_at, quality._fetched_at) IS NULL").count() == 0


def test_error_text_is_cut_in_the_run_log(spark):
    row = M.run_row(spark, run_id="x", status="failed", error_message="e" * 3000).first()
    assert len(row["error_message"]) == 1000


def test_broadcast_needs_a_small_table(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert BROADCAST_ROWS > 0
    assert hinted(broadcast_if_small(spark.range(10), max_rows=10))
    assert not hinted(broadcast_if_small(spark.range(11), max_rows=10))
    wide = spark.range(40).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    assert not hinted(broadcast_if_small(wide, max_rows=100, rows=40))
