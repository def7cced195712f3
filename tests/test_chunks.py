"""Chunked windows equal whole windows, whatever the gaps and the chunk size."""

import numpy as np
import pytest
from conftest import START
from pyspark.sql import Window
from pyspark.sql import functions as F

from wickwork.functions import series as S
from wickwork.operators import chunks
from wickwork.operators.chunks import CHUNK, OWN, Halo, plan_chunks, split_with_halo, task_count
from wickwork.operators.rolling import Rolling, with_rolling
from wickwork.plans.features import FEATURE_HALO, feature_set, with_ichimoku
from wickwork.plans.labels import LABEL_HALO, label_set
from wickwork.schema import FEATURES


def random_candles(make_candles, n, seed, density):
    rng = np.random.default_rng(seed)
    minutes = np.flatnonzero(rng.random(int(n / density)) < density)[:n]
    # a hole of several days, and a burst of dense candles after it
    minutes[len(minutes) // 2 :] += 5 * 1440
    closes = 100 + np.cumsum(rng.normal(0, 0.3, len(minutes)))
    return make_candles(
        np.round(closes, 3), minutes, np.round(rng.gamma(2.0, 3.0, len(minutes)), 3)
    )


def assert_equal_frames(a, b, keys, tolerance):
    columns = [c for c in a.columns if c not in keys]
    x = a.orderBy(*keys).toPandas()
    y = b.orderBy(*keys).toPandas()
    assert len(x) == len(y)
    for c in [*keys, *columns]:
        if x[c].dtype.kind == "f":
            np.testing.assert_allclose(x[c], y[c], rtol=tolerance, atol=tolerance, err_msg=c)
        else:
            assert x[c].equals(y[c]), c


@pytest.mark.parametrize("chunk_rows,density", [(1500, 0.9), (2000, 0.3), (700, 0.05)])
def test_chunked_features_equal_whole_ones(make_candles, chunk_rows, density):
    candles = random_candles(make_candles, 6000, chunk_rows, density).cache()
    whole = feature_set(candles, chunk_rows=None)
    chunked = feature_set(candles, chunk_rows=chunk_rows)
    assert_equal_frames(whole, chunked, ["series_id", "ts"], 1e-9)
    candles.unpersist()


@pytest.mark.parametrize("chunk_rows", [5, 40, 500])
def test_chunked_labels_equal_whole_ones(make_candles, chunk_rows):
    candles = random_candles(make_candles, 3000, 7, 0.02)
    candles = candles.unionByName(make_candles([3, 4, 5] * 10, series="SMALL")).cache()
    whole = label_set(candles, chunk_rows=None)
    chunked = label_set(candles, chunk_rows=chunk_rows)
    assert_equal_frames(whole, chunked, ["series_id", "ts"], 0)
    candles.unpersist()


def test_every_row_is_owned_once_and_halos_are_complete(make_candles):
    candles = random_candles(make_candles, 2000, 3, 0.05).cache()
    halo = Halo(back=90, ahead=25)
    split = split_with_halo(candles, halo, 100).select("ts", CHUNK, OWN).toPandas()
    owned = split[split[CHUNK] == split[OWN]]
    assert owned["ts"].is_unique and len(owned) == 2000
    position = {t: i for i, t in enumerate(sorted(owned["ts"]))}
    for _, part in split.groupby(CHUNK):
        seen = {position[t] for t in part["ts"]}
        mine = [position[t] for t in part.loc[part[CHUNK] == part[OWN], "ts"]]
        if mine:
            need = range(max(0, min(mine) - 90), min(2000, max(mine) + 26))
            assert set(need) <= seen
    candles.unpersist()


def test_one_series_holding_most_rows_is_split(spark, make_candles):
    large = random_candles(make_candles, 4000, 1, 0.9)
    small = make_candles([1, 2, 3], series="T")
    plan = plan_chunks(large.unionByName(small), FEATURE_HALO, 1000)
    chunks = {r["series_id"]: r["n"] for r in plan.groupBy("series_id").agg(
        F.countDistinct(OWN).alias("n")).collect()}
    assert chunks["S"] >= 3 and chunks["T"] == 1


def test_a_series_without_a_name_is_split(spark, make_candles):
    candles = random_candles(make_candles, 6000, 3, 0.9).withColumn("series_id", F.lit(None).cast("string"))
    split = split_with_halo(candles, LABEL_HALO, 1000)
    assert split.select(CHUNK).distinct().count() >= 4
    whole, cut = label_set(candles, chunk_rows=None), label_set(candles, chunk_rows=1000)
    assert_equal_frames(whole.drop("series_id"), cut.drop("series_id"), ["ts"], 0)


def test_chunks_without_broadcast(spark, make_candles, monkeypatch):
    """A plan table too large to broadcast meets the candles in a shuffled join."""
    candles = random_candles(make_candles, 3000, 11, 0.5).cache()
    want = label_set(candles, chunk_rows=None)
    monkeypatch.setattr(chunks, "broadcast_if_small", lambda df, rows=None: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = label_set(candles, chunk_rows=500)
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert_equal_frames(want, got, ["series_id", "ts"], 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        candles.unpersist()


def test_one_shuffle_of_the_candles(make_candles):
    candles = random_candles(make_candles, 6000, 2, 0.5).cache()
    plan = feature_set(candles, chunk_rows=1500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan and "BroadcastHashJoin" in plan
    candles.unpersist()


def test_task_count():
    assert task_count(rows=100, groups=1, parallelism=8) == 4
    assert task_count(rows=1_000_000, groups=50, parallelism=8) == 32
    assert task_count(rows=10**9, groups=50_000, parallelism=8) == 500
    assert task_count(rows=10**13, groups=10**9, parallelism=8) == 200_000


def test_halo_arithmetic():
    assert FEATURE_HALO == Halo(back=1440) and LABEL_HALO == Halo(ahead=15)
    assert Halo(1, 2) + Halo(3, 4) == Halo(4, 6)
    assert (Halo(1, 5) | Halo(3, 4)) == Halo(3, 5)


@pytest.mark.parametrize("rows", [1, 2, 7, 60, 300])
def test_block_rolling_equals_sliding_frames(make_candles, rows):
    candles = random_candles(make_candles, 1000, rows, 0.5)
    # some NULLs, and a flat stretch whose deviation must be exactly zero
    x = F.when(F.minute("ts") % 7 == 3, None).when(
        F.dayofmonth("ts") == 2, F.lit(0.1)).otherwise(F.col("close_price"))
    candles = candles.withColumn("x", x).cache()
    w = Window.partitionBy("series_id").orderBy("ts")
    specs = [Rolling("s", "std", "x", rows), Rolling("a", "avg", "x", rows)]
    got = with_rolling(candles, specs, ["series_id"], block_from=1).select("series_id", "ts", "s", "a")
    want = candles.select(
        "series_id", "ts", S.rolling_std("x", rows, w).alias("s"), S.rolling_avg("x", rows, w).alias("a")
    )
    assert_equal_frames(want, got, ["series_id", "ts"], 1e-11)
    zero = want.where(F.col("s") == 0).select("ts").collect()
    assert got.where(F.col("s") == 0).select("ts").orderBy("ts").collect() == sorted(zero)
    candles.unpersist()


def test_nested_frames_share_their_sorts(make_candles):
    candles = random_candles(make_candles, 900, 4, 0.5).cache()
    specs = [Rolling(f"s{n}", "std", "close_price", n) for n in (240, 60, 36, 12, 5)]
    got = with_rolling(candles, specs, ["series_id"], block_from=10)
    w = Window.partitionBy("series_id").orderBy("ts")
    want = candles.select(
        *candles.columns, *[S.rolling_std(s.column, s.rows, w).alias(s.name) for s in specs]
    )
    assert_equal_frames(want, got, ["series_id", "ts"], 1e-11)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # one by time, then two for 240 / 60 / 12 and two for 36
    assert plan.count("- Sort ") == 5 and plan.count("Exchange") == 1
    candles.unpersist()


def test_feature_list_is_complete(make_candles):
    out = feature_set(make_candles([1, 2, 3]))
    assert len(FEATURES) == 28
    assert [c for c in out.columns if c in FEATURES] == FEATURES
    assert out.first()["ts"] is not None and START is not None


@pytest.mark.parametrize("block_from", [1, 9, 32, 10_000])
def test_extremes_equal_sliding_frames(make_candles, block_from):
    """From shorter frames and from blocks; NULLs are skipped, also in a frame's only row."""
    candles = random_candles(make_candles, 700, 11, 0.5)
    holes = F.when(F.minute("ts") % 5 < 3, None).otherwise(F.col("close_price"))
    candles = candles.withColumn("x", holes).cache()
    w = Window.partitionBy("series_id").orderBy("ts")
    frames = (1, 2, 3, 9, 26, 52, 64, 300)
    ends = {"max": F.max, "min": F.min}
    specs = [Rolling(f"{e}{n}", e, "x", n) for e in ends for n in frames]
    got = with_rolling(candles, specs, ["series_id"], block_from=block_from)
    want = candles.select(
        *candles.columns,
        *[f("x").over(w.rowsBetween(1 - n, 0)).alias(f"{e}{n}") for e, f in ends.items() for n in frames],
    )
    assert_equal_frames(want, got, ["series_id", "ts"], 0)
    candles.unpersist()


def test_ichimoku_lines_need_one_sort(make_candles):
    plan = with_ichimoku(make_candles([1, 2, 3]), ["series_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Sort ") == 1 and plan.count("Exchange") == 1
    # only the shortest frame slides
    assert "RowFrame, -8, currentrow" in plan and "RowFrame, -51" not in plan
