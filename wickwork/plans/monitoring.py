"""Run log, step results and quality log, and the figures derived from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import tier, truncate_text
from ..operators.keys import top_per_group
from ..operators.profile import in_long_form
from ..schema import CHECKPOINT_LOG, QUALITY_LOG, RUN_LOG, STEP_LOG

# Spellings of a status, limits of the views.
STATUS_NAMES = {"pass": "success", "fail": "error", "failed": "error"}
RECENT_RUNS = 20
SHOWN_PER_GROUP = 5
ERROR_TEXT = 1000
RUN_COLUMNS = [
    "run_id",
    "status",
    "started_at",
    "duration_seconds",
    "rows_extracted",
    "rows_loaded",
]


def _stamp(as_of: datetime | None) -> Column:
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def run_row(spark, **values) -> DataFrame:
    """One row for the run log; the error text is cut to 1,000 characters."""
    row = tuple(values.get(name) for name in RUN_LOG.names)
    return spark.createDataFrame([row], RUN_LOG).withColumn(
        "error_message", truncate_text("error_message", ERROR_TEXT)
    )


def checkpoint_log_row(spark, **values) -> DataFrame:
    row = tuple(values.get(name) for name in CHECKPOINT_LOG.names)
    return spark.createDataFrame([row], CHECKPOINT_LOG)


def quality_rows(metrics: DataFrame, run_id: str, as_of: datetime | None = None) -> DataFrame:
    """Long-form metrics of one run for the quality log."""
    return in_long_form(metrics).select(
        F.lit(run_id).alias("run_id"),
        "metric_name",
        "metric_value",
        _stamp(as_of).alias("created_at"),
    ).select(*QUALITY_LOG.names)


def step_rows(steps: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Parsed steps (with run_id) in the layout of the step log."""
    return steps.withColumns(
        {"compiled_code": F.lit(None).cast("string"), "created_at": _stamp(as_of)}
    ).select(*STEP_LOG.names)


def rule_steps(results: DataFrame, table: str, run_id: str) -> DataFrame:
    """Outcome of quality rules as step results of type test."""
    return results.select(
        F.lit(run_id).alias("run_id"),
        F.lit("test").alias("resource_type"),
        F.concat_ws("_", F.lit(table), "rule", F.translate("column", ",", "_")).alias("model_name"),
        "status",
        F.lit(None).cast("double").alias("execution_time"),
        F.when(F.col("failed_rows") > 0, F.concat("failed_rows", F.lit(" rows failed"))).alias(
            "message"
        ),
    )


def union_results(models: DataFrame, tests: DataFrame) -> DataFrame:
    return models.unionByName(tests)


def normal_status(status: Column | str) -> Column:
    """Lower-case status with one spelling per outcome; NULL becomes empty text."""
    status = F.col(status) if isinstance(status, str) else status
    text = F.lower(F.coalesce(status, F.lit("")))
    out = text
    for spelling, name in STATUS_NAMES.items():
        out = F.when(text == spelling, name).otherwise(out)
    return out


def with_normal_status(steps: DataFrame) -> DataFrame:
    return steps.withColumn("status", normal_status("status"))


def filter_results(steps: DataFrame, types: list[str], statuses: list[str]) -> DataFrame:
    return steps.where(
        F.lower(F.coalesce("resource_type", F.lit(""))).isin(types)
        & F.lower(F.coalesce("status", F.lit(""))).isin(statuses)
    )


def step_kpis(steps: DataFrame) -> DataFrame:
    """Counts and total time over normalised step results."""
    status, kind = F.lower("status"), F.col("resource_type")
    return steps.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "success").alias("success"),
        F.count_if(status.isin("error", "failed")).alias("errors"),
        F.count_if(kind == "model").alias("models"),
        F.count_if(kind == "test").alias("tests"),
        F.coalesce(F.sum("execution_time"), F.lit(0.0)).alias("total_time"),
    )


def top_results(steps: DataFrame, n: int = SHOWN_PER_GROUP, tiebreak: list[str] = ()) -> DataFrame:
    """First n steps by name among models, tests and the rest."""
    group = F.when(F.col("resource_type").isin("model", "test"), F.col("resource_type")).otherwise(
        "other"
    )
    order = [F.coalesce("model_name", F.lit("")), *[F.col(c) for c in tiebreak]]
    return top_per_group(steps.withColumn("result_group", group), ["result_group"], order, n)


def step_times(steps: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    """Model steps that took time, fastest first."""
    return (
        steps.where((F.col("resource_type") == "model") & (F.col("execution_time") > 0))
        .select("model_name", "execution_time", *tiebreak)
        .orderBy("execution_time", "model_name", *tiebreak)
    )


def recent_runs(runs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    return runs.select(*RUN_COLUMNS).orderBy(F.col("started_at").desc(), "run_id").limit(n)


def run_kpis(runs: DataFrame) -> DataFrame:
    """Totals, rounded success rate with its colour, and durations over the runs."""
    ok = F.lower(F.coalesce("status", F.lit(""))) == "success"
    total, success = F.col("total_runs"), F.col("success_runs")
    rate = F.when(total > 0, F.bround(success / total * 100)).otherwise(0).cast("bigint")
    return (
        runs.agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.count_if(ok).alias("success_runs"),
            F.avg("duration_seconds").alias("mean_duration"),
            F.max("duration_seconds").alias("max_duration"),
        )
        .withColumn("failed_runs", total - success)
        .withColumn("success_rate", F.when(total > 0, rate).otherwise(0).cast("bigint"))
        .withColumn("rate_colour", F.when(F.col("success_rate") >= 90, "green").otherwise("amber"))
    )


def runs_per_day(runs: DataFrame) -> DataFrame:
    """Successful and failed runs per day, in time order, zero where there are none."""
    status = F.lower(F.coalesce("status", F.lit("unknown")))
    return (
        runs.groupBy(F.to_date("started_at").alias("day"))
        .agg(
            F.count_if(status == "success").alias("success"),
            F.count_if(status == "failed").alias("failed"),
        )
        .withColumn("day_label", F.date_format("day", "MMM dd"))
        .orderBy("day")
    )


def with_load_integrity(runs: DataFrame) -> DataFrame:
    """Loaded share of the extracted rows; 100 where either number is missing or zero."""
    extracted, loaded = F.col("rows_extracted"), F.col("rows_loaded")
    known = (F.coalesce(extracted, F.lit(0)) != 0) & (F.coalesce(loaded, F.lit(0)) != 0)
    percent = F.when(known, loaded / extracted * 100).otherwise(F.lit(100.0))
    share = F.col("integrity_pct")
    return runs.withColumn("integrity_pct", percent).withColumn(
        "integrity_tier", tier(share, share >= 99, share >= 95, ("green", "amber", "red"))
    )


_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The last value of each metric of a run; the log may hold a metric twice."""
    order = ["created_at"] if "created_at" in metrics.columns else []
    newest = F.struct(*[F.col(c) for c in (*order, "metric_value")])
    kept = metrics.groupBy("run_id", "metric_name").agg(F.max(newest).alias("_kept"))
    return kept.select("run_id", "metric_name", "_kept.*")


def monitoring_snapshot(
    runs: DataFrame, steps: DataFrame, metrics: DataFrame, exported_at: Column
) -> DataFrame:
    """The state of the pipeline as JSON records: (run_id, kind, document).

    Every run gives one record with the recent history (at most 20 runs), every step and
    every metric one of its own, whatever the size of the run.  Steps and metrics of a
    run that is not in the run log are kept.  All records carry the time they were
    fetched at.
    """
    dated = F.struct("started_at", F.struct(*RUN_COLUMNS).alias("run"))
    newest_first = F.sort_array(F.collect_list(dated), asc=False)
    history = recent_runs(runs).agg(F.transform(newest_first, lambda r: r["run"]).alias("history"))
    fetched = exported_at.alias("_fetched_at")

    def records(rows: DataFrame, kind: str, field: str, *body: str) -> DataFrame:
        part = F.struct(*[F.col(c) for c in body], fetched)
        document = F.struct("run_id", F.lit(kind).alias("kind"), part.alias(field), exported_at.alias("exported_at"))
        return rows.select("run_id", F.lit(kind).alias("kind"), F.to_json(document, _JSON).alias("document"))

    # one row of history, by construction
    with_history = runs.crossJoin(F.broadcast(history))
    values = latest_metrics(metrics)
    return (
        records(with_history, "run", "pipeline", *runs.columns, "history")
        .unionByName(records(steps, "step", "dbt", *[c for c in steps.columns if c != "run_id"]))
        .unionByName(records(values, "metric", "quality", *[c for c in values.columns if c != "run_id"]))
    )


def write_snapshot(documents: DataFrame, path: str) -> None:
    """Records as JSON lines, those of a run together; a large run is several files."""
    (
        documents.repartitionByRange("run_id", "kind", F.xxhash64("document"))
        .sortWithinPartitions("run_id", "kind", "document")
        .select("document")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .text(path)
    )
