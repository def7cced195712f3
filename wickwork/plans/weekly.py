"""The weekly job: landed payloads to marts, with run and quality logs."""

from __future__ import annotations

import time
import traceback
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..operators import rules
from ..operators.candles import in_window, silver
from ..operators.profile import quality_metrics
from ..operators.standardize import standardize, unreadable_times
from ..operators.validate import choose_source
from ..schema import QUALITY_LOG, RUN_LOG, STEP_LOG, SYMBOL_BY_SOURCE
from ..session import pinned, prepare
from ..sources import tables
from ..sources.payloads import DECODERS, read_pages, unreadable_pages
from .days import DayIndex, days_to_read, marks_of, read_days
from .features import FEATURE_HALO, with_log_volume
from .labels import LABEL_HALO
from .marts import after_mark, features_mart, labels_mart
from .monitoring import (
    checkpoint_log_row,
    monitoring_snapshot,
    quality_rows,
    rule_steps,
    run_row,
    step_rows,
    write_snapshot,
)
from .refresh import MartState, bring_up_to_date
from .rule_state import RuleState
from .versions import feature_versions

MART_KEYS = ("series_id", "version_id")


@dataclass(frozen=True)
class Lake:
    """Folders of one installation, below one root any executor can reach."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def previous_week(now: datetime) -> tuple[datetime, datetime]:
    """Start and exclusive end of the last complete week in UTC."""
    year, week, _ = now.astimezone(timezone.utc).isocalendar()
    this_monday = datetime.fromisocalendar(year, week, 1).replace(tzinfo=timezone.utc)
    return this_monday - timedelta(weeks=1), this_monday


def load_source(
    spark: SparkSession, source: str, paths: list[str], start, end, extracted_at: datetime
) -> DataFrame:
    """Landed pages of one vendor as standard candles of the window.

    A page that is not a list, or whose times cannot be read, disqualifies the source.
    """
    pages = read_pages(spark, *paths)
    if unreadable_pages(pages).take(1):
        raise ValueError("unreadable payload")
    raw = pinned(DECODERS[source](pages))  # decoded once
    if unreadable_times(raw).take(1):
        raise ValueError("unreadable timestamps")
    candles = standardize(raw, SYMBOL_BY_SOURCE[source], source, F.lit(extracted_at))
    return in_window(candles, start, end)


def extract(
    spark: SparkSession,
    landed: dict[str, list[str]],
    start,
    end,
    extracted_at: datetime,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Candles of the first source, in priority order, whose batch is valid."""
    attempts = {
        s: (lambda s=s: pinned(load_source(spark, s, landed[s], start, end, extracted_at)))
        for s in settings.source_priority
        if s in landed
    }
    return choose_source(attempts, start, end, settings.min_ratio)


def store_silver(spark: SparkSession, lake: Lake, candles: DataFrame, days: list | None = None):
    """Replace the silver days of ``candles`` and keep the day counts beside them."""
    days = tables.days_of(candles) if days is None else days
    index = DayIndex(spark, lake.silver)
    index.read()
    index.update(days, lambda: tables.overwrite_days(candles, lake.silver))


def refresh_silver(spark: SparkSession, lake: Lake, start, end, settings: Settings = DEFAULTS):
    """Rebuild the silver days a window touches from every bronze extraction of them.

    A pure function of bronze: a rerun gives the same days again.
    """
    midnight = {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}
    first = start.replace(**midnight)
    last = (end - timedelta(microseconds=1)).replace(**midnight) + timedelta(days=1)
    bronze = tables.read_bronze(spark, lake.bronze, start=first, end=last)
    days = [(first + timedelta(days=d)).date() for d in range((last - first).days)]
    store_silver(spark, lake, silver(bronze, settings.series_by_symbol), days)


def run_increment(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = DEFAULTS,
    as_of: datetime | None = None,
    full_refresh: bool = False,
    versions: DataFrame | None = None,
) -> dict[str, int]:
    """Bring both marts up to date with silver and log a checkpoint.

    Marts first, checkpoint last: after a crash the next run finds its marks in the
    marts and continues.  A full refresh replaces the rows of the active version only.
    A failure leaves an error row and is raised again.

    With ``settings.late_rows`` the marts follow late, corrected and removed candles as
    well: days that a change reaches are replaced, and a full refresh runs in windows; one
    that was broken off goes on when it is called again.
    """
    if versions is None:
        tables.replace_table(feature_versions(spark, as_of), lake.feature_versions)
        versions = spark.read.parquet(lake.feature_versions)
    versions = pinned(versions)
    active = versions.where("is_active").orderBy(F.col("created_at").desc()).first()
    if active is None:
        raise RuntimeError("No active version")
    version, started = active["version_id"], time.monotonic()

    def log(status: str, rows: int, last_ts, error: str | None = None) -> None:
        row = checkpoint_log_row(
            spark,
            version_id=version,
            last_ts=last_ts,
            rows_inserted=rows,
            duration_ms=int((time.monotonic() - started) * 1000),
            status=status,
            error_msg=error,
            created_at=as_of or datetime.now(timezone.utc),
        )
        tables.append_log(row, lake.checkpoints)

    inserted: dict[str, int] = {}
    last_ts = None
    try:
        stored = DayIndex(spark, lake.silver).read()
        if stored is None:
            raise RuntimeError("No silver table")
        for name, halo in (("features", FEATURE_HALO), ("labels", LABEL_HALO)):
            path = getattr(lake, name)
            index = DayIndex(spark, path, MART_KEYS)
            known = index.read()
            before, _ = _extent(known, version)
            if settings.late_rows:
                bring_up_to_date(
                    lake.silver, index, MartState(spark, path, version), stored, halo,
                    lambda rows, name=name: _mart(name, rows, versions, as_of, settings),
                    full_refresh, settings.window_rows,
                )
                after, latest = _extent(index.read(), version)
                inserted[name] = after if full_refresh else after - before
                last_ts = latest if name == "features" else last_ts
                continue
            candles, marks, days = _to_extend(spark, lake, stored, known, version, halo, full_refresh)
            rows = _mart(name, candles, versions, as_of, settings)
            if marks is not None:
                rows = after_mark(rows, marks)
            if full_refresh:
                index.update(days, lambda: tables.replace_version(rows, path, version))
            else:
                index.update(days, lambda: tables.append_versions(rows, path))
            after, latest = _extent(index.read(), version)
            inserted[name] = after if full_refresh else after - before
            if name == "features":
                last_ts = latest
        log("ok", inserted["features"], last_ts)
        return inserted
    except Exception as error:
        log("error", 0, last_ts, str(error)[:1000])
        raise


def _mart(name: str, candles: DataFrame, versions: DataFrame, as_of, settings: Settings) -> DataFrame:
    if name == "features":
        return features_mart(candles, versions, as_of, settings.chunk_rows)
    return labels_mart(candles, versions, as_of, settings.shock_threshold, settings.chunk_rows)


def _extent(counts: DataFrame | None, version: str) -> tuple[int, datetime | None]:
    """Rows and latest time of one version."""
    if counts is None:
        return 0, None
    own = counts.where(F.col("version_id") == version)
    return own.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.max("last_ts")).first()


def _to_extend(spark, lake: Lake, stored: DataFrame, counts, version: str, halo, full: bool):
    """Candles an increment needs, marks per series (None: all rows are new), and the days it may change."""
    silver_rows = spark.read.parquet(lake.silver)
    own = None if counts is None else counts.where(F.col("version_id") == version)
    if own is None or full or not own.take(1):
        days = {r[0] for r in stored.select(tables.DAY).distinct().collect()}
        if own is not None:
            days |= {r[0] for r in own.select(tables.DAY).distinct().collect()}
        return silver_rows.drop(tables.DAY), None, sorted(days)
    needed = days_to_read(stored, own, halo.back, halo.ahead)
    candles, days = read_days(silver_rows, needed)
    return candles.drop(tables.DAY), pinned(marks_of(own)), days


def load_history(
    spark: SparkSession,
    root: str,
    csv_path: str,
    now: datetime | None = None,
    settings: Settings = DEFAULTS,
    symbol: str = "btc",
    source: str = "bitstamp",
    cutoff: datetime | None = None,
) -> dict[str, int]:
    """Load a CSV of old candles as one bronze batch and bring silver and the marts up to date.

    Run it before the first weekly load: marts only grow behind their marks.
    """
    prepare(spark)
    lake, now = Lake(root), now or datetime.now(timezone.utc)
    history = tables.read_history_csv(spark, csv_path, symbol, source, cutoff)
    candles = pinned(tables.history_as_bronze(history, now))
    first, last = candles.agg(F.min("open_time"), F.max("open_time")).first()
    if first is None:
        return {"features": 0, "labels": 0}
    tables.write_bronze(candles, lake.bronze, f"history-{source}")
    utc = timezone.utc
    start, end = first.replace(tzinfo=utc), last.replace(tzinfo=utc) + timedelta(minutes=1)
    refresh_silver(spark, lake, start, end, settings)
    return run_increment(spark, lake, settings, now)


def table_rules(spark: SparkSession, lake: Lake, versions: DataFrame) -> list[tuple[str, RuleState]]:
    """The rules of the growing tables, counted by day beside them."""
    known = rules.References(("version_id",), versions, ("version_id",))
    silver_days = DayIndex(spark, lake.silver)

    def mart(path: str, own: list) -> RuleState:
        return RuleState(DayIndex(spark, path, MART_KEYS), (*own, known))

    return [
        ("silver", RuleState(silver_days, (*rules.SILVER_RULES, *rules.CANDLE_CHECKS))),
        ("returns", RuleState(silver_days, tuple(rules.RETURNS_RULES), "returns_rules", with_log_volume)),
        ("features", mart(lake.features, rules.FEATURE_RULES)),
        ("labels", mart(lake.labels, rules.LABEL_RULES)),
    ]


def check_tables(
    spark: SparkSession, lake: Lake, run_id: str, batch: DataFrame, now: datetime
) -> DataFrame:
    """Quality rules of the loaded batch, silver, both marts, versions and this run's checkpoint.

    Of the tables that grow only the days that have changed are read.
    """
    versions = spark.read.parquet(lake.feature_versions)
    checkpoint = spark.read.parquet(lake.checkpoints).where(F.col("created_at") == F.lit(now))
    results = [
        ("bronze", rules.evaluate(batch, rules.BRONZE_RULES)),
        *[(name, state.evaluate()) for name, state in table_rules(spark, lake, versions)],
        ("feature_versions", rules.evaluate(versions, rules.VERSION_RULES)),
        ("checkpoints", rules.evaluate(checkpoint, rules.CHECKPOINT_RULES)),
    ]
    return reduce(DataFrame.unionByName, [rule_steps(found, name, run_id) for name, found in results])


def export_snapshot(spark: SparkSession, lake: Lake, now: datetime) -> None:
    """The logs as one set of JSON lines; a log that does not exist yet is empty."""

    def log(path: str, layout) -> DataFrame:
        if tables.table_exists(spark, path):
            return spark.read.schema(layout).parquet(path)
        return spark.createDataFrame([], layout)

    documents = monitoring_snapshot(
        log(lake.pipeline_runs, RUN_LOG),
        log(lake.step_results, STEP_LOG),
        log(lake.data_quality, QUALITY_LOG),
        F.lit(now),
    )
    write_snapshot(documents, lake.snapshot)


def run_week(
    spark: SparkSession,
    root: str,
    landed: dict[str, list[str]],
    now: datetime | None = None,
    settings: Settings = DEFAULTS,
    window: tuple[datetime, datetime] | None = None,
) -> str:
    """Load one window, refresh the marts, check them and log the run; returns run_id.

    ``landed`` maps each source to its payload files.  A longer ``window`` is the
    backfill of a history.
    """
    prepare(spark)
    lake = Lake(root)
    now = now or datetime.now(timezone.utc)
    start, end = window or previous_week(now)
    run_id, clock = str(uuid.uuid4()), time.monotonic()
    extracted = loaded = None
    status, message = "success", None
    try:
        batch = extract(spark, landed, start, end, now, settings)
        extracted = batch.count()
        label = f"{start:%Y%m%d%H%M}"
        tables.write_bronze(batch, lake.bronze, label)
        loaded = tables.read_batch(spark, lake.bronze, label).count()
        refresh_silver(spark, lake, start, end, settings)
        run_increment(spark, lake, settings, now)
        steps = pinned(check_tables(spark, lake, run_id, batch, now))
        tables.append_log(step_rows(steps, now), lake.step_results)
        metrics = quality_metrics(batch)
        tables.append_log(quality_rows(metrics, run_id, now), lake.data_quality)
        failed = [r["model_name"] for r in steps.where("status = 'fail'").collect()]
        if failed:
            raise RuntimeError(f"Quality rules failed: {', '.join(sorted(failed))}")
    except Exception:
        status, message = "failed", traceback.format_exc()
        raise
    finally:
        row = run_row(
            spark,
            run_id=run_id,
            pipeline_name="candle-weekly",
            status=status,
            started_at=now,
            ended_at=now + timedelta(seconds=time.monotonic() - clock),
            duration_seconds=round(time.monotonic() - clock, 2),
            rows_extracted=extracted,
            rows_loaded=loaded,
            error_message=message,
        )
        tables.append_log(row, lake.pipeline_runs)
        export_snapshot(spark, lake, now)
    return run_id
