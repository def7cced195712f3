import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wickwork.session import get_spark  # noqa: E402

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.debug.maxToStringFields": "200",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_candles(spark):
    """Silver rows from closes; minutes default to 0, 1, 2, ..."""

    def build(closes, minutes=None, volumes=None, symbols=None, series="S", spread=1.0):
        minutes = range(len(closes)) if minutes is None else minutes
        volumes = [1.0] * len(closes) if volumes is None else volumes
        symbols = [series] * len(closes) if symbols is None else symbols
        rows = [
            (
                series,
                symbol,
                START + timedelta(minutes=int(m)),
                "1m",
                float(c),
                float(c) + spread,
                float(c) - spread,
                float(c),
                float(v),
                "test",
                START + timedelta(minutes=int(m), days=1),
                True,
            )
            for c, m, v, symbol in zip(closes, minutes, volumes, symbols)
        ]
        schema = (
            "series_id string, symbol string, ts timestamp, timeframe string, open_price double,"
            "high_price double, low_price double, close_price double, volume double,"
            "source string, ingested_at timestamp, is_closed boolean"
        )
        return spark.createDataFrame(rows, schema)

    return build


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]
