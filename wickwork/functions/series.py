"""Column templates over a time-ordered candle series.

Every function takes columns (or names) and a ``WindowSpec`` that is already
partitioned and ordered, and returns a ``Column`` built from Spark built-ins.
Frames count rows, not minutes: a missing minute stretches the horizon.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """NULL instead of an error or infinity when the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def log_return(price: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """ln(price / price n rows ago); NULL without history or for ratios <= 0."""
    p = _col(price)
    return F.ln(safe_divide(p, F.lag(p, n).over(w)))


def future_log_return(price: ColumnOrName, horizon: int, w: WindowSpec) -> Column:
    """ln(price ``horizon`` rows ahead / price)."""
    p = _col(price)
    return F.ln(safe_divide(F.lead(p, horizon).over(w), p))


def log_volume(volume: ColumnOrName) -> Column:
    return F.ln(F.nullif(_col(volume), F.lit(0.0)))


def lag_feature(x: ColumnOrName, n: int, w: WindowSpec) -> Column:
    return F.lag(_col(x), n).over(w)


def rolling_std(x: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """Sample deviation of the last n rows; NULL for a single value."""
    return F.stddev_samp(_col(x)).over(w.rowsBetween(-(n - 1), 0))


def rolling_avg(x: ColumnOrName, n: int, w: WindowSpec) -> Column:
    return F.avg(_col(x)).over(w.rowsBetween(-(n - 1), 0))


def ichimoku_midpoint(highest: ColumnOrName, lowest: ColumnOrName) -> Column:
    """Middle of the highest high and the lowest low of the last rows."""
    return (_col(highest) + _col(lowest)) / 2


def _strict(fn, cols) -> Column:
    """Apply ``greatest``/``least`` but return NULL as soon as one input is NULL."""
    cols = [_col(c) for c in cols]
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, fn(*cols))


def strict_greatest(*cols: ColumnOrName) -> Column:
    return _strict(F.greatest, cols)


def strict_least(*cols: ColumnOrName) -> Column:
    return _strict(F.least, cols)


def binary_signal(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def shock_label(price: ColumnOrName, horizon: int, threshold: float, w: WindowSpec) -> Column:
    """1 if the absolute future log return reaches the threshold, else 0."""
    return binary_signal(F.abs(future_log_return(price, horizon, w)) >= threshold)


def valid_label_horizon(ts: ColumnOrName, horizon_minutes: int, reference: ColumnOrName) -> Column:
    """True where ``horizon_minutes`` have passed between ``ts`` and the reference time."""
    return _col(ts) <= _col(reference) - F.expr(f"INTERVAL {int(horizon_minutes)} MINUTES")


def incremental_filter(df: DataFrame, mark, ts: str = "ts") -> DataFrame:
    """Rows after the high-water mark; ``mark=None`` (no target yet) keeps all rows."""
    if mark is None:
        return df
    return df.where(F.col(ts) > (mark if isinstance(mark, Column) else F.lit(mark)))
