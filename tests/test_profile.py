"""Whole-row duplicates by fingerprints, against plain counting."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wickwork.operators import profile

NAN = float("nan")
ROWS = [
    ("a", 1.5, 1, 10), ("a", 1.5, 1, 10), ("a", 1.5, 1, 10),
    ("a", NAN, 2, 20), ("a", NAN, 2, 20),
    ("a", 0.0, 3, 30), ("a", -0.0, 3, 30),
    ("b", None, 1, 40), ("b", None, 1, 40),
    ("b", 2.0, None, 1), ("b", 2.0, 1, None),
    (None, 1.5, 1, 10), (None, 1.5, 1, 10),
    (None, None, None, None), (None, None, None, None),
    ("c", 7.0, 7, 70),
]
SCHEMA = "source string, price double, volume bigint, open_time bigint"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("open_time", F.timestamp_seconds("open_time"))


def plain(row):
    """NaN and zeros of any sign as values that equal themselves."""
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v + 0.0 if isinstance(v, float) else v for v in row)


def surplus(rows):
    return sum(n - 1 for n in Counter(map(plain, rows)).values())


def test_surplus_copies_equal_plain_counting(rows):
    assert profile.duplicate_rows(rows).first()[0] == surplus(ROWS) == 7


def test_metrics_of_groups_equal_plain_counting(rows):
    found = {r.source: r for r in profile.quality_metrics(rows, ["source"]).collect()}
    assert set(found) == {"a", "b", "c", None}
    for source, r in found.items():
        mine = [row for row in ROWS if row[0] == source]
        missing = sum(v is None or v != v for row in mine for v in row[1:])
        times = [row[3] for row in mine if row[3] is not None]
        assert (r.row_count, r.null_count, r.duplicate_count) == (len(mine), missing, surplus(mine))
        assert (r.min_timestamp, r.max_timestamp) == (min(times), max(times))
        assert r.column_count == 3


def test_an_empty_table_has_zeros(rows):
    none = rows.where("false")
    assert profile.duplicate_rows(none).first()[0] == 0
    whole = profile.quality_metrics(none).first()
    assert (whole.row_count, whole.null_count, whole.duplicate_count) == (0, 0, 0)
    assert whole.min_timestamp is None
    assert profile.quality_metrics(none, ["source"]).count() == 0


def test_rows_whose_fingerprints_meet_stay_apart(rows, monkeypatch):
    same = lambda df: df.withColumns({c: F.lit(0) for c in profile.FINGERPRINT})
    monkeypatch.setattr(profile, "_with_fingerprint", same)
    assert profile.duplicate_rows(rows).first()[0] == surplus(ROWS)


def test_keys_too_many_to_broadcast_are_joined(rows, monkeypatch):
    monkeypatch.setattr(profile, "broadcast_if_small", lambda df: df)
    assert profile.duplicate_rows(rows).first()[0] == surplus(ROWS)


def test_all_rows_move_as_fingerprints_only(spark, rows, monkeypatch):
    """However many columns a row has, the shuffle of all rows carries the two hashes and a count."""
    pinned, plans = profile.pinned, []

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return pinned(df)

    monkeypatch.setattr(profile, "pinned", seen)
    wide = rows.withColumns({f"extra_{i}": F.lit(i) + F.col("volume") for i in range(30)})
    profile.duplicate_rows(wide).collect()
    keys = plans[0].split("Aggregate [")[1].split("]")[0]
    assert keys.count("_low") == keys.count("_high") == 1 and "extra" not in keys
