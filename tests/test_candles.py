"""Payloads, standardisation, silver, validation and fallback."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from wickwork.functions import scalars as Z
from wickwork.operators import candles as C
from wickwork.operators.standardize import coerce_numeric, parse_mixed_ts, standardize, unreadable_times
from wickwork.operators.validate import choose_source, minimum_rows, source_fallback, validate_batch
from wickwork.schema import BRONZE, series_of
from wickwork.sources import payloads, tables
from wickwork.sources.steps import parse_step_results, read_step_documents

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)


def bronze(spark, *entries):
    """Rows of (minute, extraction day, overrides)."""
    out = []
    for minute, day, changes in entries:
        row = {
            "open_time": START + timedelta(minutes=minute),
            "close_time": START + timedelta(minutes=minute + 1),
            "open": 100.0, "high": 110.0, "low": 90.0, "close": 105.0, "volume": 1.5,
            "symbol": "BTCUSDT", "interval": "1m", "source": "binance",
            "extracted_at": START + timedelta(days=day),
        } | changes
        out.append(tuple(row[c] for c in BRONZE.names))
    return spark.createDataFrame(out, BRONZE)


def batch(spark, n=10, **changes):
    return bronze(spark, *[(i, 1, {}) for i in range(n)])


def test_standardize_text_candle(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "100", "110", "90", "105", "12.5")],
        "open_time string, close_time string, open string, high string, low string, close string, volume string",
    )
    out = standardize(raw, "BTCUSDT", "binance", F.lit(AS_OF))
    assert out.columns == BRONZE.names
    assert out.schema.simpleString() == BRONZE.simpleString()
    row = out.first()
    assert (row["source"], row["symbol"], row["interval"], row["volume"]) == ("binance", "BTCUSDT", "1m", 12.5)
    assert row["open_time"] == datetime(2024, 1, 1)


@pytest.mark.parametrize("turn", [1, -1])
def test_standardize_keeps_the_complete_duplicate(spark, turn):
    whole = ("2024-01-01T00:00:00Z", "2024-01-01T00:01:00Z", "9", "9", "9", "9", "1")
    holes = ("2024-01-01T00:00:00Z", "2024-01-01T00:01:00Z", None, "5", "5", None, "1")
    columns = "open_time string, close_time string, open string, high string, low string, close string, volume string"
    raw = spark.createDataFrame([whole, holes][::turn], columns)
    (row,) = standardize(raw, "X", "s", F.lit(AS_OF)).collect()
    assert (row["open"], row["close"]) == (9.0, 9.0)


def test_standardize_empty_input(spark):
    raw = batch(spark).where("false").drop("symbol", "interval", "source", "extracted_at")
    out = standardize(raw, "BTCUSDT", "binance", F.lit(AS_OF))
    assert out.columns == BRONZE.names and out.count() == 0


def test_coerce_numeric_and_times(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("",), ("1.5d",), ("1e3",), (None,), ("inf",), ("NaN",)], "x string")
    got = [r[0] for r in df.select(coerce_numeric("x")).collect()]
    assert got == [1.5, None, None, None, 1000.0, None, float("inf"), None]
    df = spark.createDataFrame([("1704067200000",), ("2024-01-01T00:00:00.0000000Z",), ("soon",)], "x string")
    got = [r[0] for r in df.select(parse_mixed_ts("x")).collect()]
    assert got == [datetime(2024, 1, 1), datetime(2024, 1, 1), None]


def test_unreadable_times(spark):
    df = spark.createDataFrame([("1704067200000", "2024-01-01"), ("soon", "2024-01-01")], "open_time string, close_time string")
    assert unreadable_times(df).count() == 1


def test_numeric_times_and_missing_prices(spark):
    nan = float("nan")
    raw = spark.createDataFrame(
        [(1704067200000.0, 1704067260000, 1.0, nan, 0.5, 1.0, 2.0)],
        "open_time double, close_time bigint, open double, high double, low double, close double, volume double",
    )
    (row,) = standardize(raw, "X", "s", F.lit(AS_OF)).collect()
    assert (row["open_time"], row["close_time"]) == (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1))
    assert row["high"] is None


def test_nan_prices(spark):
    nan = float("nan")
    b = bronze(spark, (0, 1, {"high": nan}), (1, 1, {"low": nan}), (2, 1, {}))
    assert C.silver_filter(b).count() == 1
    assert validate_batch(b, START, START + timedelta(minutes=3), 1.0) is True


def test_unreadable_pages(spark):
    pages = spark.createDataFrame([("[]",), ("[[1]]",), ('[{"a":1}]',), ("<html>",), ('{"msg":1}',)], "payload string")
    assert {r[0] for r in payloads.unreadable_pages(pages).collect()} == {"<html>", '{"msg":1}'}


KLINES = '[[1704067200000,"100","110","90","105","12.5",1704067259999,"0",1,"0","0","0"]]'
ARRAYS = "[[1704067200,90,110,100,105,12.5]]"
OBJECTS = (
    '[{"time_period_start":"2024-01-01T00:00:00.0000000Z","time_period_end":"2024-01-01T00:01:00.0000000Z",'
    '"price_open":100,"price_high":110,"price_low":90,"price_close":105,"volume_traded":12.5,"trades_count":3}]'
)


@pytest.mark.parametrize("source,text", [("binance", KLINES), ("coinbase", ARRAYS), ("coinapi", OBJECTS)])
def test_payload_shapes(spark, tmp_path, source, text):
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("not json")
    pages = payloads.read_pages(spark, str(tmp_path))
    assert pages.count() == 3
    (row,) = standardize(payloads.DECODERS[source](pages), "X", source, F.lit(AS_OF)).collect()
    assert row["open_time"] == datetime(2024, 1, 1)
    assert tuple(row[c] for c in ("open", "high", "low", "close", "volume")) == (100, 110, 90, 105, 12.5)
    assert row["close_time"].minute in (0, 1)


def test_silver_keeps_latest_valid_extraction(spark):
    b = bronze(
        spark,
        (0, 1, {"close": 1.0}), (0, 2, {"close": 2.0}),
        (1, 1, {"high": 80.0}), (2, 1, {"close": None}), (3, 1, {"high": None}),
        (4, 1, {"open_time": None}),
        (5, 1, {}), (5, 1, {"symbol": "BTC-USD", "source": "coinbase"}),
    )
    out = rows(C.silver(b), "ts")
    assert [(r["close_price"], r["source"]) for r in out] == [(2.0, "binance"), (105.0, "binance")]
    assert {r["series_id"] for r in out} == {"BTC"} and out[0]["timeframe"] == "1m" and out[0]["is_closed"]


def test_series_of_unknown_symbol(spark):
    df = spark.createDataFrame([("btc",), ("BTC/USDT",), ("ETHUSDT",), (None,)], "symbol string")
    assert [r[0] for r in df.select(series_of("symbol")).collect()] == ["BTC", "BTC", "ETHUSDT", None]


def test_validate_batch(spark):
    end = START + timedelta(minutes=10)
    good = batch(spark)
    assert validate_batch(good, START, end, 0.8) is True
    assert validate_batch(good.limit(0), START, end, 0.8) is False
    assert validate_batch(good.drop("volume"), START, end, 0.8) is False
    twice = bronze(spark, *[(0 if i == 1 else i, 1, {}) for i in range(10)])
    assert validate_batch(twice, START, end, 0.8) is False
    inverted = bronze(spark, *[(i, 1, {"high": 80.0} if i == 0 else {}) for i in range(10)])
    assert validate_batch(inverted, START, end, 0.8) is False
    unknown = bronze(spark, *[(i, 1, {"high": None} if i == 0 else {}) for i in range(10)])
    assert validate_batch(unknown, START, end, 0.8) is True


def test_completeness_boundary(spark):
    assert minimum_rows(10_080, 0.95) == 9_576 and minimum_rows(525_599, 0.95) == 499_319
    end = START + timedelta(minutes=10)
    assert validate_batch(batch(spark, 8), START, end, 0.85) is True
    assert validate_batch(batch(spark, 7), START, end, 0.85) is False


def test_choose_source(spark):
    end = START + timedelta(minutes=10)

    def down():
        raise ConnectionError("vendor down")

    good, short = batch(spark), batch(spark, 3)
    assert choose_source({"a": good, "b": short}, START, end, 0.8) is good
    assert choose_source({"a": down, "b": lambda: good}, START, end, 0.8) is good
    with pytest.raises(RuntimeError, match=r"All sources failed: a: vendor down \| b: invalid data"):
        choose_source({"a": down, "b": short}, START, end, 0.8)


def test_source_fallback_per_window(spark):
    weeks = bronze(
        spark,
        *[(i, 1, {}) for i in range(3)],
        *[(i, 1, {"source": "coinbase"}) for i in range(10)],
        *[(10_080 + i, 1, {}) for i in range(10)],
        *[(10_080 + i, 1, {"source": "coinbase"}) for i in range(10)],
        *[(20_160 + i, 1, {}) for i in range(2)],
    )
    start = F.date_trunc("week", "open_time")
    df = weeks.withColumns({"w0": start, "w1": start + F.expr("INTERVAL 7 DAYS")})
    out = source_fallback(df, ["binance", "coinbase"], [], "w0", "w1", 0.0008)
    got = {(r["w0"].day, r["source"]): r["n"] for r in out.groupBy("w0", "source").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, "coinbase"): 10, (8, "binance"): 10}


def test_scalar_time(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 12:30:45.123456' AS t, TIMESTAMP'2024-01-01 12:00:00' AS u, TIMESTAMP'2024-01-01' AS v")
    start, end = Z.previous_full_week("t")
    row = df.select(
        Z.to_milliseconds("v").alias("ms"), Z.floor_to_minute("t").alias("m"), Z.iso_utc("u").alias("iso"),
        Z.iso_utc("t").alias("iso_f"), start.alias("s"), end.alias("e"), Z.week_label("t").alias("w"),
        Z.expected_minutes("v", "t").alias("n"),
    ).first()
    assert row["ms"] == 1704067200000 and row["m"] == datetime(2024, 1, 1, 12, 30)
    assert row["iso"] == "2024-01-01T12:00:00Z" and row["iso_f"] == "2024-01-01T12:30:45.123456Z"
    assert (row["s"], row["e"]) == (datetime(2023, 12, 25), datetime(2024, 1, 1))
    assert row["w"] == "20240101" and row["n"] == 750


def test_bronze_round_trip_by_week(spark, tmp_path):
    path = str(tmp_path / "bronze")
    first = bronze(spark, (0, 1, {}), (10_080, 1, {}))
    tables.write_bronze(first, path)
    tables.write_bronze(bronze(spark, (0, 2, {"close": 1.0})), path)
    back = tables.read_bronze(spark, path)
    assert back.schema.simpleString() == BRONZE.simpleString()
    got = [(r["open_time"], r["close"]) for r in back.orderBy("open_time").collect()]
    assert got == [(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 8), 105.0)]
    assert list((tmp_path / "bronze" / "week_start=2024-01-01").rglob("*.snappy.parquet"))
    week = tables.read_bronze(spark, path, start=START, end=START + timedelta(days=7))
    assert week.count() == 1
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in plan


def test_history_csv(spark, tmp_path):
    file = tmp_path / "history.csv"
    file.write_text("timestamp,open,high,low,close,volume\n1704067200.0,1,2,0.5,1.5,3\n1704067260.0,1,2,0.5,1.5,3\n")
    out = tables.read_history_csv(spark, str(file), cutoff=START + timedelta(minutes=1))
    (row,) = out.collect()
    assert row["ts"] == datetime(2024, 1, 1) and row["close_price"] == 1.5
    assert (row["symbol"], row["source"]) == ("btc", "bitstamp")
    as_bronze = tables.history_as_bronze(out, AS_OF)
    assert sorted(as_bronze.columns) == sorted(BRONZE.names)
    union = tables.bronze_union(as_bronze, bronze(spark, (0, 1, {})))
    assert C.silver(union).count() == 1
    tables.replace_table(out, str(tmp_path / "t"))
    tables.replace_table(out, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_schema_evolution(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, symbol string")
    out = C.evolve_schema(old, new, {"symbol": "BTC/USDT"})
    assert sorted(map(tuple, out.collect())) == [(1, "BTC/USDT"), (2, "x")]


def test_step_documents(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"results":[{"unique_id":"model.p.features","status":"success","execution_time":1.5},'
        '{"unique_id":"test.p.not_null_ts.abc","status":"pass","message":null},'
        '{"unique_id":"test.p","status":"fail"},{"unique_id":"","status":"x"},{"status":"y"}]}'
    )
    docs = read_step_documents(spark, str(tmp_path / "r.json"), str(tmp_path / "absent.json"))
    got = [(r["resource_type"], r["model_name"], r["status"]) for r in parse_step_results(docs).collect()]
    assert got == [
        ("model", "features", "success"), ("test", "not_null_ts", "pass"), ("test", "p", "fail"),
        (None, None, "x"), (None, None, "y"),
    ]
    assert parse_step_results(read_step_documents(spark, str(tmp_path / "absent.json"))).count() == 0
