"""Increments, the weekly job and the stream equal one full run."""

import json
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from wickwork.config import Settings
from wickwork.operators.candles import silver
from wickwork.plans import marts as M
from wickwork.plans.versions import feature_versions
from wickwork.plans.days import DayIndex, days_to_read, read_days
from wickwork.plans.weekly import (
    Lake,
    load_history,
    previous_week,
    run_increment,
    run_week,
    store_silver,
)
from wickwork.schema import BRONZE, FEATURES
from wickwork.session import pinned
from wickwork.sources import tables
from wickwork.streaming.runner import run_available

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
SMALL = Settings(chunk_rows=1600)


@pytest.fixture(scope="module")
def candles(spark, make_candles):
    rng = np.random.default_rng(5)
    parts = []
    for series, n, density in (("S", 4000, 0.6), ("T", 2500, 0.2)):
        minutes = np.flatnonzero(rng.random(int(n / density)) < density)
        closes = np.round(100 + np.cumsum(rng.normal(0, 0.3, len(minutes))), 3)
        volumes = np.round(rng.gamma(2.0, 3.0, len(minutes)), 3)
        parts.append(make_candles(closes, minutes, volumes, series=series))
    return pinned(parts[0].unionByName(parts[1]))


@pytest.fixture(scope="module")
def versions(spark):
    return pinned(feature_versions(spark, AS_OF))


def assert_same(a, b, keys=("series_id", "ts"), tolerance=1e-9):
    columns = sorted(c for c in b.columns if c not in (tables.DAY, "computed_at"))
    x = a.select(*columns).orderBy(*keys).toPandas()
    y = b.select(*columns).orderBy(*keys).toPandas()
    assert len(x) == len(y)
    for c in columns:
        if x[c].dtype.kind == "f":
            np.testing.assert_allclose(x[c], y[c], rtol=tolerance, atol=tolerance, err_msg=c)
        else:
            assert x[c].equals(y[c]), c


def test_mart_layout(candles, versions):
    mart = M.features_mart(candles, versions, AS_OF)
    assert mart.columns == [
        "series_id", "ts", "version_id", "computed_at", "raw_ingested_at", "source", *FEATURES, "symbol", "timeframe",
    ]
    labels = M.labels_mart(candles, versions, AS_OF)
    assert labels.columns == [
        "series_id", "ts", "version_id", "computed_at", "y_logret_5m", "y_logret_15m", "y_shock_15m", "symbol", "timeframe",
    ]


def test_feature_increment_equals_full_run(candles, versions):
    mark = START + timedelta(days=4)
    full = M.features_mart(candles, versions, AS_OF, 1600).where(F.col("ts") > F.lit(mark))
    assert_same(M.feature_increment(candles, versions, mark, AS_OF, 1600), full)


def test_marks_per_series(candles, versions, spark):
    marks = pinned(spark.createDataFrame([("S", START + timedelta(days=3))], "series_id string, mark timestamp"))
    later = (F.col("series_id") == "T") | (F.col("ts") > F.lit(START + timedelta(days=3)))
    full = M.features_mart(candles, versions, AS_OF).where(later)
    assert_same(M.feature_increment(candles, versions, marks, AS_OF), full)


def test_lookback_reads_rows_not_minutes(make_candles):
    minutes = [*range(0, 100), *range(100_000, 100_010)]
    candles = make_candles(range(1, 111), minutes)
    mark = START + timedelta(minutes=100_004)
    kept = M.with_lookback(candles, mark, 50)
    assert kept.count() == 110
    kept = M.with_lookback(candles, mark, 5)
    assert kept.count() == 10


def test_high_water_and_checkpoints(make_candles, spark):
    candles = make_candles([1, 2, 3])
    assert M.high_water(candles).first()["mark"] == datetime(2024, 1, 1, 0, 2)
    assert M.high_water(candles.limit(0)).first()["mark"] == datetime(1970, 1, 1)
    row = M.checkpoint_row(candles, candles.limit(2), ["series_id"]).first()
    assert (row["rows_inserted"], row["status"]) == (2, "ok")


def test_upsert_days_rewrites_only_touched_days(spark, make_candles, tmp_path):
    path = str(tmp_path / "t")
    old = make_candles([1, 2, 3], minutes=[0, 1440, 2880])
    tables.append_days(old, path)
    untouched = sorted((tmp_path / "t" / "ts_date=2024-01-01").glob("*.parquet"))
    new = pinned(make_candles([9, 7], minutes=[1440, 1441]))
    tables.upsert_days(spark, path, new, ["series_id", "ts"])
    got = [r["close_price"] for r in rows(spark.read.parquet(path), "ts")]
    assert got == [1, 9, 7, 3]
    assert sorted((tmp_path / "t" / "ts_date=2024-01-01").glob("*.parquet")) == untouched


def write_silver(candles, lake, days):
    rows = candles.where(F.col("ts") < F.lit(START + timedelta(days=days)))
    store_silver(candles.sparkSession, lake, rows)


def test_runs_in_steps_equal_one_full_refresh(spark, candles, tmp_path):
    steps, whole = Lake(str(tmp_path / "steps")), Lake(str(tmp_path / "whole"))
    for days in (2, 5, 5, 60):
        write_silver(candles, steps, days)
        run_increment(spark, steps, SMALL, AS_OF)
    write_silver(candles, whole, 60)
    counts = run_increment(spark, whole, SMALL, AS_OF)
    assert counts["features"] == candles.count()
    for name in ("features", "labels"):
        a = spark.read.parquet(getattr(steps, name))
        b = spark.read.parquet(getattr(whole, name))
        assert_same(a, b)
        assert a.groupBy("series_id", "ts", "version_id").count().where("count > 1").count() == 0
    log = rows(spark.read.parquet(steps.checkpoints), "last_ts", "rows_inserted")
    assert [r["status"] for r in log] == ["ok"] * 4
    assert sum(r["rows_inserted"] for r in log) == candles.count()
    assert sorted(r["rows_inserted"] for r in log)[0] == 0
    # a full refresh replaces the table and gives the same rows
    run_increment(spark, steps, SMALL, AS_OF, full_refresh=True)
    assert_same(spark.read.parquet(steps.features), spark.read.parquet(whole.features))


@pytest.mark.parametrize("with_ended", [True, False])
def test_ended_and_new_series(spark, make_candles, tmp_path, with_ended):
    """Ended, new, young, gapped and nameless series give the rows of one full run."""
    lake = Lake(str(tmp_path / "a"))
    day = 1440
    parts = [make_candles(range(1, 2401), range(20 * day, 20 * day + 2400), series="RUN")]
    if with_ended:
        parts.append(make_candles(range(1, 200), range(0, 199), series="ENDED"))
    parts.append(make_candles(range(3, 63), range(21 * day, 21 * day + 60), series="YOUNG"))
    parts.append(make_candles(range(1, 41), [m * 700 for m in range(40)], series="GAPS"))
    parts.append(make_candles(range(7, 47), range(20 * day, 20 * day + 40), series="N").withColumn("series_id", F.lit(None)))
    first = pinned(unioned(parts))
    store_silver(spark, lake, first)
    run_increment(spark, lake, SMALL, AS_OF)
    parts.append(make_candles(range(2401, 2451), range(20 * day + 2400, 20 * day + 2450), series="RUN"))
    parts.append(make_candles(range(5, 305), range(3 * day, 3 * day + 300), series="NEW"))
    parts.append(make_candles(range(63, 93), range(21 * day + 60, 21 * day + 90), series="YOUNG"))
    parts.append(make_candles(range(41, 61), [m * 700 for m in range(40, 60)], series="GAPS"))
    parts.append(make_candles(range(47, 87), range(20 * day + 40, 20 * day + 80), series="N").withColumn("series_id", F.lit(None)))
    everything = pinned(unioned(parts))
    store_silver(spark, lake, everything)
    counts = run_increment(spark, lake, SMALL, AS_OF)
    assert counts["features"] == everything.count() - first.count()
    assert run_increment(spark, lake, SMALL, AS_OF) == {"features": 0, "labels": 0}
    whole = Lake(str(tmp_path / "b"))
    store_silver(spark, whole, everything)
    run_increment(spark, whole, SMALL, AS_OF)
    for name in ("features", "labels"):
        assert_same(spark.read.parquet(getattr(lake, name)), spark.read.parquet(getattr(whole, name)))


def unioned(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def test_increment_reads_recent_folders_only(spark, make_candles, tmp_path):
    """A young and an ended series do not open the history."""
    lake = Lake(str(tmp_path))
    ts = F.timestamp_seconds(F.col("id") * 60 + int(START.timestamp()))
    template = make_candles([1.0]).drop("ts", "series_id")
    ended = make_candles([1, 2, 3], series="ENDED")
    young = make_candles(range(1, 50), range(39 * 1440 - 49, 39 * 1440), series="YOUNG")
    long = spark.range(39 * 1440).select(F.lit("LONG").alias("series_id"), ts.alias("ts")).crossJoin(template)
    first = long.select(*ended.columns).unionByName(ended).unionByName(young)
    store_silver(spark, lake, first)
    run_increment(spark, lake, SMALL, AS_OF)
    more = spark.range(39 * 1440, 40 * 1440).select(F.lit("LONG").alias("series_id"), ts.alias("ts")).crossJoin(template)
    later = make_candles(range(50, 60), range(39 * 1440, 39 * 1440 + 10), series="YOUNG")
    store_silver(spark, lake, more.select(*ended.columns).unionByName(later))
    stored = DayIndex(spark, lake.silver).read()
    for name, back, ahead, days in (("features", 1440, 0, 3), ("labels", 0, 15, 2)):
        done = DayIndex(spark, getattr(lake, name), ("series_id", "version_id")).read()
        rows, read = read_days(spark.read.parquet(lake.silver), days_to_read(stored, done, back, ahead))
        assert len(read) == days and min(read) >= (START + timedelta(days=40 - days)).date()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [ts_date" in plan or "PartitionFilters: [isnotnull(ts_date" in plan
        assert rows.where("series_id = 'ENDED'").count() == 0


def test_day_counts_survive_a_broken_write(spark, make_candles, tmp_path):
    lake = Lake(str(tmp_path))
    store_silver(spark, lake, make_candles([1, 2, 3]))
    index = DayIndex(spark, lake.silver)

    def broken():
        tables.overwrite_days(make_candles([1, 2, 3, 4, 5]), lake.silver)
        raise OSError("lost")

    with pytest.raises(OSError):
        index.update([START.date()], broken)
    assert [r["rows"] for r in index.read().collect()] == [5]


def test_a_refresh_keeps_other_versions(spark, make_candles, tmp_path):
    lake = Lake(str(tmp_path))
    store_silver(spark, lake, make_candles(range(1, 61)))
    one = feature_versions(spark, AS_OF)
    two = one.withColumn("version_id", F.lit("2/b"))
    run_increment(spark, lake, SMALL, AS_OF, versions=one)
    run_increment(spark, lake, SMALL, AS_OF, versions=two)
    assert run_increment(spark, lake, SMALL, AS_OF, versions=two, full_refresh=True)["features"] == 60
    assert run_increment(spark, lake, SMALL, AS_OF, versions=two) == {"features": 0, "labels": 0}
    found = spark.read.parquet(lake.features).groupBy("version_id").count().collect()
    assert {r["version_id"]: r["count"] for r in found} == {"v1": 60, "2/b": 60}


def test_history_file_feeds_the_marts(spark, tmp_path):
    path = tmp_path / "history.csv"
    s = int(START.timestamp())
    lines = [f"{s + 60 * m},100,101,99,100.5,{m + 1}" for m in range(100)]
    path.write_text("\n".join(["timestamp,open,high,low,close,volume", *lines]))
    counts = load_history(spark, str(tmp_path / "lake"), str(path), AS_OF, SMALL, cutoff=START + timedelta(minutes=80))
    assert counts == {"features": 80, "labels": 65}


def test_late_rows_stay_out_of_the_marts(spark, make_candles, tmp_path):
    lake = Lake(str(tmp_path))
    store_silver(spark, lake, make_candles([1, 2, 3], minutes=[0, 2, 3]))
    run_increment(spark, lake, SMALL, AS_OF)
    store_silver(spark, lake, make_candles([1, 9, 2, 3, 4], minutes=[0, 1, 2, 3, 4]))
    run_increment(spark, lake, SMALL, AS_OF)
    got = [r["ts"].minute for r in rows(spark.read.parquet(lake.features), "ts")]
    assert got == [0, 2, 3, 4]
    run_increment(spark, lake, SMALL, AS_OF, full_refresh=True)
    assert spark.read.parquet(lake.features).count() == 5


def test_failed_increment_leaves_an_error_checkpoint(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(Exception):
        run_increment(spark, lake, SMALL, AS_OF)
    (row,) = spark.read.parquet(lake.checkpoints).collect()
    assert row["status"] == "error" and row["error_msg"] and row["rows_inserted"] == 0
    retired = feature_versions(spark, AS_OF).withColumn("is_active", F.lit(False))
    with pytest.raises(RuntimeError, match="No active version"):
        run_increment(spark, lake, SMALL, AS_OF, versions=retired)


def klines(start, minutes, price=100.0):
    ms = int(start.timestamp() * 1000)
    return json.dumps(
        [
            [ms + 60_000 * m, str(price + m % 9), str(price + m % 9 + 1), str(price + m % 9 - 1), str(price + m % 9 + m % 3 / 2),
             "2.5", ms + 60_000 * m + 59_999, "0", 1, "0", "0", "0"]
            for m in minutes
        ]
    )


def arrays(start, minutes):
    s = int(start.timestamp())
    return json.dumps([[s + 60 * m, 98, 103, 100, 101 + m % 2, 1.5] for m in minutes])


def test_weekly_job_end_to_end(spark, tmp_path):
    root, land = str(tmp_path / "lake"), tmp_path / "land"
    land.mkdir()
    (land / "k1.json").write_text(klines(START, range(200)))
    (land / "k2.json").write_text(klines(START, range(150, 300)))
    second = START + timedelta(minutes=300)
    (land / "bad.json").write_text(klines(second, range(10)))
    (land / "c.json").write_text(arrays(second, range(300)))
    lake = Lake(root)
    settings = Settings(chunk_rows=1600)
    run_week(spark, root, {"binance": [str(land / "k1.json"), str(land / "k2.json")]}, now=AS_OF,
             settings=settings, window=(START, second))
    landed = {"binance": [str(land / "bad.json")], "coinbase": [str(land / "c.json")]}
    run_week(spark, root, landed, now=AS_OF + timedelta(days=7), settings=settings,
             window=(second, second + timedelta(minutes=300)))
    silver_rows = spark.read.parquet(lake.silver)
    assert silver_rows.count() == 600
    assert {r["source"] for r in silver_rows.select("source").distinct().collect()} == {"binance", "coinbase"}
    features = spark.read.parquet(lake.features)
    assert features.count() == 600 and features.where("lag_logret_1m_60 IS NULL").count() == 61
    assert spark.read.parquet(lake.labels).count() == 585
    runs = rows(spark.read.parquet(lake.pipeline_runs), "started_at")
    assert [(r["status"], r["rows_extracted"], r["rows_loaded"]) for r in runs] == [("success", 300, 300)] * 2
    assert spark.read.parquet(lake.data_quality).count() == 12
    steps = spark.read.parquet(lake.step_results)
    assert steps.where("status = 'pass'").count() == steps.count() > 20
    records = [json.loads(r[0]) for r in spark.read.text(lake.snapshot).collect()]
    assert sum(r["kind"] == "run" for r in records) == 2
    assert sum(r["kind"] == "step" for r in records) == steps.count()
    with pytest.raises(RuntimeError, match="All sources failed: binance: invalid data"):
        run_week(spark, root, {"binance": [str(land / "bad.json")]}, now=AS_OF + timedelta(days=14),
                 settings=settings, window=(second, second + timedelta(minutes=300)))
    failed = rows(spark.read.parquet(lake.pipeline_runs), "started_at")[-1]
    assert failed["status"] == "failed" and "All sources failed" in failed["error_message"]


def test_failing_rules_fail_the_run(spark, tmp_path):
    """A batch without volume passes validation and breaks the rules of the returns."""
    (tmp_path / "k.json").write_text(klines(START, range(100)).replace('"2.5"', '"0"'))
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(RuntimeError, match="Quality rules failed: returns_not_null_log_volume"):
        run_week(spark, lake.root, {"binance": [str(tmp_path / "k.json")]}, now=AS_OF,
                 settings=SMALL, window=(START, START + timedelta(minutes=100)))
    (run,) = spark.read.parquet(lake.pipeline_runs).collect()
    assert run["status"] == "failed" and run["rows_loaded"] == 100
    tested = {r[0].split("_")[0] for r in spark.read.parquet(lake.step_results).select("model_name").collect()}
    assert tested == {"bronze", "silver", "returns", "features", "labels", "feature", "checkpoints"}


def test_previous_week():
    assert previous_week(datetime(2024, 1, 17, 12, tzinfo=timezone.utc)) == (
        datetime(2024, 1, 8, tzinfo=timezone.utc), datetime(2024, 1, 15, tzinfo=timezone.utc))


def as_bronze(candles, day):
    return candles.select(
        F.col("ts").alias("open_time"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("close_time"),
        *[F.col(f"{c}_price").alias(c) for c in ("open", "high", "low", "close")],
        "volume", "symbol", F.lit("1m").alias("interval"), "source",
        F.lit(START + timedelta(days=day)).alias("extracted_at"),
    ).select(*BRONZE.names)


def test_stream_equals_batch(spark, candles, tmp_path):
    settings = Settings(chunk_rows=1600, series_by_symbol={})
    cut = F.lit(START + timedelta(days=4))
    files = [
        as_bronze(candles.where(F.col("ts") < cut), 30),
        # newer candles, and a second extraction of the same ones with other prices
        as_bronze(candles.where(F.col("ts") >= cut), 31).unionByName(
            as_bronze(candles.where(F.col("ts") >= cut).withColumn("close_price", F.col("close_price") + 0.5), 32)
        ),
    ]
    root = str(tmp_path / "stream")
    lake = Lake(root)
    for f in files:
        f.coalesce(1).write.mode("append").parquet(lake.bronze)
        run_available(spark, root, str(tmp_path / "cp"), settings, as_of=AS_OF)
    run_available(spark, root, str(tmp_path / "cp"), settings, as_of=AS_OF)
    whole = Lake(str(tmp_path / "batch"))
    store_silver(spark, whole, silver(files[0].unionByName(files[1]), {}))
    run_increment(spark, whole, settings, AS_OF)
    for name in ("silver", "features", "labels"):
        assert_same(spark.read.parquet(getattr(lake, name)), spark.read.parquet(getattr(whole, name)))


def test_stream_and_batch_agree_on_ties(spark, make_candles, tmp_path):
    """Equal extraction times: the smaller source wins, whichever came first."""
    settings = Settings(chunk_rows=None, series_by_symbol={})
    for name, order in (("x", ("b", "a")), ("y", ("a", "b"))):
        lake = Lake(str(tmp_path / name))
        for source in order:
            rows_ = make_candles([ord(source)]).withColumn("source", F.lit(source))
            as_bronze(rows_, 9).coalesce(1).write.mode("append").parquet(lake.bronze)
            run_available(spark, lake.root, str(tmp_path / f"cp-{name}"), settings, as_of=AS_OF)
        assert [r["source"] for r in spark.read.parquet(lake.silver).collect()] == ["a"]


def test_stream_ignores_an_older_extraction(spark, make_candles, tmp_path):
    settings = Settings(chunk_rows=None, series_by_symbol={})
    lake = Lake(str(tmp_path))
    for close, day in ((5, 9), (4, 2)):
        as_bronze(make_candles([close]), day).coalesce(1).write.mode("append").parquet(lake.bronze)
        run_available(spark, str(tmp_path), str(tmp_path / "cp"), settings, as_of=AS_OF)
    assert [r["close_price"] for r in spark.read.parquet(lake.silver).collect()] == [5.0]
