"""Marts that follow late, corrected and removed candles equal one full run."""

import threading
from datetime import datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pytest
from conftest import START
from pyspark.sql import functions as F
from test_marts import assert_same

from wickwork.config import Settings
from wickwork.operators.chunks import Halo
from wickwork.plans import refresh, weekly
from wickwork.plans.days import DayIndex
from wickwork.plans.weekly import Lake, run_increment, store_silver
from wickwork.session import pinned
from wickwork.sources import tables

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
FOLLOW = Settings(chunk_rows=1600, late_rows=True)


@pytest.fixture(scope="module")
def candles(make_candles):
    """S: some 700 rows a day; T: sparse; a gap of five days in both."""
    rng = np.random.default_rng(8)
    parts = []
    for series, n, density in (("S", 6000, 0.5), ("T", 600, 0.04)):
        minutes = np.flatnonzero(rng.random(int(n / density)) < density)
        minutes = minutes + np.where(minutes > 4 * 1440, 5 * 1440, 0)
        closes = np.round(100 + np.cumsum(rng.normal(0, 0.3, len(minutes))), 3)
        parts.append(make_candles(closes, minutes, np.round(rng.gamma(2.0, 3.0, len(minutes)), 3), series=series))
    return pinned(parts[0].unionByName(parts[1]))


@pytest.fixture(scope="module")
def whole(spark, candles, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("whole")))
    store_silver(spark, lake, candles)
    run_increment(spark, lake, Settings(chunk_rows=1600), AS_OF)
    return lake


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def same_marts(spark, lake, other):
    for name in ("features", "labels"):
        assert_same(spark.read.parquet(getattr(lake, name)), spark.read.parquet(getattr(other, name)))


def test_marts_follow_every_change(spark, candles, whole, tmp_path):
    lake = Lake(str(tmp_path / "a"))
    # late, corrected and removed candles on three days, and an early end
    late = (F.xxhash64("series_id", "ts") % 7 == 0) & (F.col("series_id") == "S")
    day = F.dayofmonth("ts")
    first = candles.where(F.col("ts") < F.lit(START + timedelta(days=14)))
    first = first.where(~(late & (day == 1)) & ~((day == 11) & (F.col("series_id") == "T")))
    first = first.withColumn("close_price", F.when((day == 12) & (F.hour("ts") == 3), 5.0).otherwise(F.col("close_price")))
    extra = candles.where(day == 13).limit(40).withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 SECONDS"))
    store_silver(spark, lake, pinned(first.unionByName(extra)))
    run_increment(spark, lake, FOLLOW, AS_OF)
    before = files(lake.features)
    store_silver(spark, lake, candles)
    run_increment(spark, lake, FOLLOW, AS_OF)
    same_marts(spark, lake, whole)
    # 1,440 rows behind the late ones, and before the next change
    kept = {f for f, t in files(lake.features).items() if before.get(f) == t}
    assert {f.split("ts_date=")[1][:10] for f in kept} >= {"2024-01-10"}
    # nothing has changed since: nothing is written
    now = files(lake.root)
    assert run_increment(spark, lake, FOLLOW, AS_OF) == {"features": 0, "labels": 0}
    marts = {f: t for f, t in now.items() if "/features/" in f or "/labels/" in f}
    assert marts == {f: t for f, t in files(lake.root).items() if f in marts}


def test_a_killed_refresh_goes_on(spark, candles, whole, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "b"))
    settings = Settings(chunk_rows=1600, late_rows=True, window_rows=2000)
    store_silver(spark, lake, candles)
    windows, plain = [], tables.overwrite_days

    def killed(df, path):
        if "/features/" in path:
            windows.append(tables.days_of(df))
            if len(windows) == 3:
                raise OSError("killed")
        plain(df, path)

    monkeypatch.setattr(tables, "overwrite_days", killed)
    with pytest.raises(OSError):
        run_increment(spark, lake, settings, AS_OF, full_refresh=True)
    done = files(lake.features)
    finished = windows[:2]
    run_increment(spark, lake, settings, AS_OF, full_refresh=True)
    again = windows[3:]
    # finished windows stay as they are and are not made again
    assert again[0] == windows[2] and not set(sum(finished, [])) & set(sum(again, []))
    assert all(files(lake.features)[f] == t for f, t in done.items())
    same_marts(spark, lake, whole)
    # without a broken one, a refresh begins anew
    count = len(windows)
    run_increment(spark, lake, settings, AS_OF, full_refresh=True)
    assert sum(windows[count:], []) == sum(finished, []) + sum(again, [])


def test_small_windows_are_made_side_by_side(spark, candles, whole, tmp_path, monkeypatch):
    lake, plain = Lake(str(tmp_path / "c")), DayIndex._recount
    store_silver(spark, lake, candles)
    counted, threads, make = [], set(), weekly._mart
    monkeypatch.setattr(DayIndex, "_recount", lambda self, days: counted.append(len(days)) or plain(self, days))
    monkeypatch.setattr(weekly, "_mart", lambda *a: threads.add(threading.get_ident()) or make(*a))
    settings = Settings(chunk_rows=1600, late_rows=True, window_rows=2000)
    run_increment(spark, lake, settings, AS_OF, full_refresh=True)
    run_increment(spark, lake, settings, AS_OF, full_refresh=True)
    # the days of all windows of a mart are counted at once
    assert len(counted) <= 2 and len(threads) > 1
    same_marts(spark, lake, whole)


def test_groups_of_windows_are_bounded(monkeypatch):
    days = [START.date() + timedelta(days=d) for d in range(30)]
    cut = [([d], 10) for d in days]
    assert [len(g) for g in refresh.together(cut)] == [8, 8, 8, 6]
    monkeypatch.setattr(refresh, "ROWS_AT_ONCE", 25)
    assert [len(g) for g in refresh.together(cut)] == [2] * 15
    assert refresh.together([([d], 30) for d in days]) == [[[d]] for d in days]
    assert refresh.together([]) == []


def test_reach_of_a_change_in_days(spark):
    """Twenty rows a day; a frame of 45 rows reaches three days, one of 15 ahead the day before."""
    schema = "series_id string, ts_date date, rows bigint, digest decimal(38,0)"
    days = [START.date() + timedelta(days=d) for d in range(12)]
    now = spark.createDataFrame([(s, d, 20, i) for s in "AB" for i, d in enumerate(days)], schema.replace("decimal(38,0)", "bigint"))
    changed = F.col("ts_date").isin(days[4]) & (F.col("series_id") == "A")
    then = now.withColumn("digest", F.when(changed, -1).otherwise(F.col("digest")).cast("decimal(38,0)"))

    def found(df):
        return sorted((r["series_id"], days.index(r["ts_date"])) for r in df.collect())

    dirty = refresh.dirty_days(now, then, None, Halo(back=45, ahead=15))
    assert found(dirty) == [("A", d) for d in (3, 4, 5, 6, 7)]
    assert found(refresh.days_needed(now, dirty, Halo(back=45))) == [("A", d) for d in range(0, 8)]
    assert found(refresh.days_needed(now, dirty, Halo(ahead=15))) == [("A", d) for d in range(3, 9)]
    # a removed day counts as changed, also if only the mart still has it
    gone = now.where(F.col("ts_date") != days[11])
    assert found(refresh.dirty_days(gone, now, None, Halo(back=1))) == [("A", 11), ("B", 11)]
    assert found(refresh.dirty_days(gone, gone, now, Halo(ahead=1))) == [("A", 10), ("A", 11), ("B", 10), ("B", 11)]
