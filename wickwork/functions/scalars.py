"""Time and number helpers used around the candle tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .series import ColumnOrName, _col


def floor_to_minute(ts: ColumnOrName) -> Column:
    return F.date_trunc("minute", _col(ts))


def to_milliseconds(ts: ColumnOrName) -> Column:
    """Epoch milliseconds, truncated."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def iso_utc(ts: ColumnOrName) -> Column:
    """ISO text ending in Z; microseconds are written only if there are any."""
    t = _col(ts).cast("timestamp")
    whole = F.unix_micros(t) % 1_000_000 == 0
    return F.when(whole, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Epoch seconds as a double, with the fraction."""
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1e6)


def week_start(ts: ColumnOrName) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", _col(ts))


def previous_full_week(reference: ColumnOrName) -> tuple[Column, Column]:
    """Start and exclusive end of the last complete Monday-to-Monday week."""
    monday = week_start(reference)
    return monday - F.expr("INTERVAL 7 DAYS"), monday


def week_label(ts: ColumnOrName) -> Column:
    """yyyyMMdd of the week's Monday, as used in file names."""
    return F.date_format(week_start(ts), "yyyyMMdd")


def expected_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes between two times."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(
        _col(start).cast("timestamp")
    )
    return F.floor(micros / 60_000_000).cast("bigint")


def truncate_text(text: ColumnOrName, limit: int = 1000) -> Column:
    return F.substring(_col(text), 1, limit)


def tier(value: Column, good: Column, fair: Column, names=("ok", "warn", "fail")) -> Column:
    """First name if ``good`` holds, second if ``fair`` does, else the third."""
    best, middle, worst = names
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(good, best).when(fair, middle).otherwise(worst)
    )


def alert(value: ColumnOrName, warn: float, danger: float) -> Column:
    """green / amber / red for a value that should stay low."""
    v = _col(value)
    return F.when(v >= danger, "red").when(v >= warn, "amber").otherwise("green")
