"""Run log, step results and the monitoring document."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import monitoring as M
from ..sources.steps import parse_step_results
from . import fixtures as X
from .registry import query

_KIND = "step_no, resource_type, model_name, status, execution_time, message"
_NORMAL = """CASE status WHEN 'pass' THEN 'success' WHEN 'fail' THEN 'error'
  WHEN 'failed' THEN 'error' ELSE status END"""
_CLEAN = f"SELECT * REPLACE ({_NORMAL} AS status) FROM ({X.STEPS_SQL})"


def _steps(spark, d):
    return parse_step_results(X.step_documents(spark, d))


def _clean(spark, d):
    return M.with_normal_status(_steps(spark, d))


@query("parse_step_results", f"SELECT {_KIND} FROM ({X.STEPS_SQL})")
def parse(spark, d):
    return _steps(spark, d)


@query(
    "union_results",
    f"""SELECT {_KIND} FROM ({X.STEPS_SQL}) WHERE resource_type = 'model'
    UNION ALL SELECT {_KIND} FROM ({X.STEPS_SQL}) WHERE resource_type = 'test'""",
)
def union_results(spark, d):
    steps = _steps(spark, d)
    kind = F.col("resource_type")
    return M.union_results(steps.where(kind == "model"), steps.where(kind == "test"))


@query("normalize_status", f"SELECT step_no, {_NORMAL} AS status FROM ({X.STEPS_SQL})")
def normalize_status(spark, d):
    return _clean(spark, d).select("step_no", "status")


@query(
    "filter_results",
    f"SELECT {_KIND} FROM ({_CLEAN}) WHERE resource_type = 'test' AND status IN ('error', 'warn')",
)
def filter_results(spark, d):
    return M.filter_results(_clean(spark, d), ["test"], ["error", "warn"])


@query(
    "step_kpis",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
      count(*) FILTER (WHERE status = 'error') AS errors,
      count(*) FILTER (WHERE resource_type = 'model') AS models,
      count(*) FILTER (WHERE resource_type = 'test') AS tests,
      round(sum(execution_time), 4) AS total_time FROM ({_CLEAN})""",
)
def step_kpis(spark, d):
    return M.step_kpis(_clean(spark, d)).withColumn("total_time", F.round("total_time", 4))


@query(
    "top_results",
    f"""SELECT resource_type AS result_group, rank, step_no, model_name, status FROM (
      SELECT *, row_number() OVER (PARTITION BY resource_type ORDER BY model_name, step_no) AS rank
      FROM ({_CLEAN})) WHERE rank <= 5""",
)
def top_results(spark, d):
    top = M.top_results(_clean(spark, d), tiebreak=["step_no"])
    return top.select(
        "result_group", F.col("rank").cast("bigint").alias("rank"), "step_no", "model_name", "status"
    )


@query(
    "step_times",
    f"""SELECT step_no, model_name, execution_time FROM ({_CLEAN})
    WHERE resource_type = 'model' AND execution_time > 0
    ORDER BY execution_time, model_name, step_no""",
)
def step_times(spark, d):
    return M.step_times(_clean(spark, d), tiebreak=["step_no"])


@query(
    "recent_runs",
    f"SELECT * FROM ({X.RUN_LOG_SQL}) ORDER BY started_at DESC, run_id LIMIT 20",
)
def recent_runs(spark, d):
    return M.recent_runs(X.run_log(spark, d))


@query(
    "run_kpis",
    f"""SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'success') AS success_runs,
      round(avg(duration_seconds), 6) AS mean_duration, max(duration_seconds) AS max_duration,
      count(*) FILTER (WHERE status <> 'success') AS failed_runs,
      CAST(round_even(count(*) FILTER (WHERE status = 'success') / count(*) * 100, 0) AS BIGINT)
        AS success_rate,
      CASE WHEN round_even(count(*) FILTER (WHERE status = 'success') / count(*) * 100, 0) >= 90
        THEN 'green' ELSE 'amber' END AS rate_colour
    FROM ({X.RUN_LOG_SQL})""",
)
def run_kpis(spark, d):
    kpis = M.run_kpis(X.run_log(spark, d))
    return kpis.withColumn("mean_duration", F.round("mean_duration", 6))


@query(
    "runs_per_day",
    f"""SELECT CAST(started_at AS DATE) AS day,
      count(*) FILTER (WHERE status = 'success') AS success,
      count(*) FILTER (WHERE status = 'failed') AS failed,
      strftime(CAST(started_at AS DATE), '%b %d') AS day_label
    FROM ({X.RUN_LOG_SQL}) GROUP BY 1 ORDER BY 1""",
)
def runs_per_day(spark, d):
    return M.runs_per_day(X.run_log(spark, d))


_SHARE = (
    "CASE WHEN rows_extracted <> 0 AND rows_loaded <> 0 "
    "THEN rows_loaded / rows_extracted * 100 ELSE 100.0 END"
)


@query(
    "load_integrity",
    f"""SELECT run_id, rows_extracted, rows_loaded, {_SHARE} AS integrity_pct,
      CASE WHEN {_SHARE} >= 99 THEN 'green' WHEN {_SHARE} >= 95 THEN 'amber' ELSE 'red' END
        AS integrity_tier FROM ({X.RUN_LOG_SQL})""",
)
def load_integrity(spark, d):
    runs = M.with_load_integrity(X.run_log(spark, d))
    return runs.select(
        "run_id", "rows_extracted", "rows_loaded", "integrity_pct", "integrity_tier"
    )


# Runs of very different sizes: run k holds 2 ** k consecutive events.
_RUN_OF = "CAST(CAST(floor(log2(event_id + 1)) AS BIGINT) AS VARCHAR)"
_READ_BACK = (
    "struct<run_id:string,kind:string,exported_at:timestamp,"
    "pipeline:struct<status:string,rows_loaded:bigint,_fetched_at:timestamp,"
    "history:array<struct<run_id:string>>>,"
    "dbt:struct<resource_type:string,model_name:string,status:string,execution_time:double,"
    "message:string>,quality:struct<metric_name:string,metric_value:double,created_at:timestamp>>"
)


@query(
    "monitoring_snapshot",
    f"""WITH runs AS (SELECT {_RUN_OF} AS run_id, min(ts) AS started_at, count(*) AS n, max(ts) AS ended,
        CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 10 THEN 'failed' ELSE 'success' END
          AS status FROM events GROUP BY 1),
    log AS (SELECT * FROM runs WHERE run_id <> '3')
    SELECT run_id, 'run' AS kind, status, n AS rows_loaded,
      least(20, (SELECT count(*) FROM log)) AS history_runs,
      (SELECT arg_max(run_id, started_at) FROM log) AS newest_run,
      NULL::VARCHAR AS name, NULL::DOUBLE AS value, NULL::VARCHAR AS message,
      TIMESTAMP '2024-02-01' AS at FROM log
    UNION ALL
    SELECT {_RUN_OF}, 'step', status, NULL, NULL, NULL, resource_type || ' ' || model_name,
      execution_time, message, TIMESTAMP '2024-02-01'
    FROM (SELECT step_no AS event_id, * FROM ({X.STEPS_SQL}))
    UNION ALL
    SELECT run_id, 'metric', NULL, NULL, NULL, NULL, 'row_count', CAST(n AS DOUBLE), NULL, ended
    FROM runs""",
)
def monitoring_snapshot(spark, d):
    """Run 3 is missing from the run log; its steps and its metric stay. Metrics come twice."""
    run_id = F.floor(F.log2(F.col("event_id") + 1)).cast("string").alias("run_id")
    events = X.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    count = F.count(F.lit(1))
    failed = F.count_if(F.col("event_type") == "error") > 10
    runs = events.groupBy(run_id).agg(
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.min("ts").alias("started_at"),
        F.sum("value").alias("duration_seconds"),
        count.alias("rows_extracted"),
        count.alias("rows_loaded"),
    )
    numbered = _steps(spark, d).withColumnRenamed("step_no", "event_id")
    steps = numbered.select(run_id, *[c for c in numbered.columns if c != "event_id"])
    last = events.groupBy(run_id).agg(
        F.lit("row_count").alias("metric_name"),
        count.cast("double").alias("metric_value"),
        F.max("ts").alias("created_at"),
    )
    earlier = last.withColumns(
        {"metric_value": F.lit(-1.0), "created_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")}
    )
    documents = M.monitoring_snapshot(
        runs.where("run_id <> '3'"), steps, last.unionByName(earlier), F.lit(X.AS_OF)
    )
    read = documents.select("run_id", "kind", F.from_json("document", _READ_BACK).alias("d"))
    run, step, metric = F.col("d.pipeline"), F.col("d.dbt"), F.col("d.quality")
    kind = F.concat_ws(" ", step["resource_type"], step["model_name"])
    return read.select(
        F.col("d.run_id").alias("run_id"),
        F.col("d.kind").alias("kind"),
        F.coalesce(run["status"], step["status"]).alias("status"),
        run["rows_loaded"].alias("rows_loaded"),
        F.when(run.isNotNull(), F.size(run["history"])).cast("bigint").alias("history_runs"),
        F.try_element_at(run["history"], F.lit(1))["run_id"].alias("newest_run"),
        F.when(step.isNotNull(), kind).otherwise(metric["metric_name"]).alias("name"),
        F.coalesce(step["execution_time"], metric["metric_value"]).alias("value"),
        step["message"].alias("message"),
        F.coalesce(metric["created_at"], F.col("d.exported_at")).alias("at"),
    )
