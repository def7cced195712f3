"""Forward-looking labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CHUNK_ROWS, DEFAULTS
from ..functions import series as S
from ..operators.chunks import Halo
from .features import over_series

# Horizons in rows.
LABEL_HORIZONS = (5, 15)
SHOCK_HORIZON = 15
LABEL_HALO = Halo(ahead=max(*LABEL_HORIZONS, SHOCK_HORIZON))


def label_set(
    candles: DataFrame,
    shock_threshold: float = DEFAULTS.shock_threshold,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Future returns and the shock label, before rows without a future are dropped."""

    def build(df, w, keys):
        labels = {f"y_logret_{h}m": S.future_log_return("close_price", h, w) for h in LABEL_HORIZONS}
        shock = S.shock_label("close_price", SHOCK_HORIZON, shock_threshold, w)
        return df.withColumns({**labels, f"y_shock_{SHOCK_HORIZON}m": shock})

    candles = candles.select("series_id", "symbol", "timeframe", "ts", "close_price")
    return over_series(candles, LABEL_HALO, build, chunk_rows).drop("close_price")


def with_future(labels: DataFrame) -> DataFrame:
    """Only rows whose returns are both known; the others wait for later candles."""
    known = [F.col(f"y_logret_{h}m").isNotNull() for h in LABEL_HORIZONS]
    return labels.where(known[0] & known[1])
