"""Hand-computed micro-series."""

import math

import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from wickwork.functions import series as S
from wickwork.plans.features import feature_set
from wickwork.plans.labels import label_set, with_future



def close_to(a, b):
    return (a is None and b is None) or (
        a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-15)
    )


def test_constant_series_has_zero_deviation(make_candles):
    out = rows(feature_set(make_candles([100] * 100)), "ts")
    assert out[0]["logret_1m"] is None and out[1]["logret_1m"] == 0
    assert out[1]["vol_60m"] is None and out[2]["vol_60m"] == 0
    assert out[5]["vol_annualized"] == 0
    assert all(r["vol_ratio"] is None and r["vol_zscore"] is None for r in out)


def test_flat_stretch_inside_a_long_frame_is_exactly_flat(make_candles):
    closes = [0.1 * 1.1**i for i in range(50)] + [0.1] * 1600
    out = rows(feature_set(make_candles(closes, spread=0.0)), "ts")
    assert out[-1]["vol_1d"] == 0 and out[-1]["vol_ratio"] is None
    assert out[1400]["vol_1d"] > 0


def test_doubling_series(make_candles):
    out = rows(feature_set(make_candles([1, 2, 4, 8])), "ts")
    assert [r["logret_1m"] for r in out][0] is None
    assert all(close_to(r["logret_1m"], math.log(2)) for r in out[1:])
    assert out[2]["lag_logret_1m_1"] == out[1]["logret_1m"]


def test_zero_price_gives_null_returns(make_candles):
    out = rows(feature_set(make_candles([100, 0, 100])), "ts")
    assert [r["logret_1m"] for r in out] == [None, None, None]
    assert out[1]["tenkan_dist"] is None


def test_zero_volume_gives_null_log(make_candles):
    assert rows(feature_set(make_candles([5], volumes=[0])), "ts")[0]["log_volume"] is None


def test_single_row(make_candles):
    (row,) = rows(feature_set(make_candles([10])), "ts")
    assert row["vol_60m"] is None and row["vol_1d"] is None
    assert row["tenkan"] == 10 and row["span_a"] == 10
    assert (row["tenkan_sup_kijun"], row["price_sup_cloud"], row["price_sub_cloud"]) == (0, 0, 0)
    assert row["lag_price_sup_cloud_5"] is None
    assert row["vol_ma_60m"] == 1


def test_frames_count_rows_across_a_gap(make_candles):
    out = rows(feature_set(make_candles([1, 2, 4, 8], minutes=[0, 1, 5, 6])), "ts")
    assert all(close_to(r["logret_1m"], math.log(2)) for r in out[1:])


def test_vendor_switch_does_not_cut_the_series(make_candles):
    closes = [100 + i % 7 for i in range(80)]
    one = rows(feature_set(make_candles(closes)).drop("symbol"), "ts")
    symbols = ["BTCUSDT"] * 40 + ["BTC-USD"] * 40
    two = rows(feature_set(make_candles(closes, symbols=symbols)).drop("symbol"), "ts")
    assert one == two


def test_lagged_signal_is_null_for_five_rows(make_candles):
    out = rows(feature_set(make_candles(range(10, 40))), "ts")
    assert [r["lag_price_sup_cloud_5"] for r in out[:5]] == [None] * 5
    assert [r["lag_price_sup_cloud_5"] for r in out[5:]] == [r["price_sup_cloud"] for r in out[:-5]]


def test_ichimoku_by_hand(make_candles):
    closes = [50 + (i * 37) % 23 for i in range(70)]
    out = rows(feature_set(make_candles(closes)), "ts")
    for i, r in enumerate(out):
        for name, n in (("tenkan", 9), ("kijun", 26), ("span_b", 52)):
            frame = closes[max(0, i - n + 1) : i + 1]
            assert r[name] == (max(frame) + 1 + min(frame) - 1) / 2


def test_shock_label(make_candles):
    closes = [100.0] * 16 + [100.0] * 15
    closes[15] = 102.0
    closes[16] = 100.5
    out = rows(label_set(make_candles(closes)), "ts")
    assert out[0]["y_shock_15m"] == 1
    assert out[1]["y_shock_15m"] == 0
    assert out[-1]["y_shock_15m"] == 0 and out[-1]["y_logret_15m"] is None


def test_tail_is_unlabelled_until_more_candles_arrive(make_candles):
    closes = [100 + i % 5 for i in range(45)]
    early = rows(with_future(label_set(make_candles(closes[:30]))), "ts")
    late = rows(with_future(label_set(make_candles(closes))), "ts")
    assert (len(early), len(late)) == (15, 30)
    assert late[:15] == early


def test_valid_label_horizon(spark, make_candles):
    kept = make_candles([1] * 30).where(S.valid_label_horizon("ts", 15, F.lit(START) + F.expr("INTERVAL 20 MINUTES")))
    assert kept.count() == 6


def test_strict_extremes_return_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    got = df.select(S.strict_greatest("a", "b").alias("g"), S.strict_least("a", "b").alias("l"))
    assert [tuple(r) for r in got.collect()] == [(2.0, 1.0), (None, None)]


def test_signal_of_null_condition_is_zero(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "a double")
    assert [r[0] for r in df.select(S.binary_signal(F.col("a") > 0)).collect()] == [0, 1]


@pytest.mark.parametrize("mark,expected", [(None, 3), (START, 2)])
def test_incremental_filter(make_candles, mark, expected):
    assert S.incremental_filter(make_candles([1, 2, 3]), mark).count() == expected
