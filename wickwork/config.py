"""Job settings; the defaults are the reference values of the feature set."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import schema


@dataclass(frozen=True)
class Settings:
    # share of the expected candles a batch must hold
    min_ratio: float = 0.95
    # absolute future log return that counts as a shock
    shock_threshold: float = 0.01
    # rows of one series handled by one window group (14 days of 1-minute candles)
    chunk_rows: int | None = 20_160
    # marts also follow candles that arrive or change behind their marks
    late_rows: bool = False
    # with late_rows: rows that are made anew at once
    window_rows: int = 200_000_000
    source_priority: list[str] = field(default_factory=lambda: list(schema.SOURCE_PRIORITY))
    series_by_symbol: dict[str, str] = field(default_factory=lambda: dict(schema.SERIES_BY_SYMBOL))


DEFAULTS = Settings()
CHUNK_ROWS = DEFAULTS.chunk_rows
