from .scalars import (
    alert,
    epoch_seconds,
    expected_minutes,
    floor_to_minute,
    iso_utc,
    previous_full_week,
    tier,
    to_milliseconds,
    truncate_text,
    week_label,
    week_start,
)
from .series import (
    binary_signal,
    future_log_return,
    ichimoku_midpoint,
    incremental_filter,
    lag_feature,
    log_return,
    log_volume,
    rolling_avg,
    rolling_std,
    safe_divide,
    shock_label,
    strict_greatest,
    strict_least,
    valid_label_horizon,
)

__all__ = [name for name in dir() if not name.startswith("_")]
