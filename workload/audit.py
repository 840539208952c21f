"""Run and log history."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from recordflow.operators import audit
from recordflow.plans.report import dated
from recordflow.plans.spec import Sink
from recordflow.plans.staging import StagingArea
from recordflow.sinks.writers import write_sink
from workload.registry import query, table

RUN_COLUMNS = (
    "pipeline_id, metadata_name, status, start_time, end_time, duration_seconds, total_records, "
    "valid_records, invalid_records"
)
LISTED_METHOD_SQL = "CASE WHEN pipeline_id LIKE 'airflow\\_%' ESCAPE '\\' THEN 'airflow' ELSE 'direct' END"
TOTALS_SQL = (
    "count(*) AS total_runs, count(*) FILTER (WHERE status = 'success') AS successful_runs, "
    "count(*) FILTER (WHERE status = 'failed') AS failed_runs"
)
RATE_SQL = "CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) * 100 AS success_rate"
# Few enough that the busiest stages of the test tables take several rows.
LINES_A_PART = 20
LOG_COLUMNS = "log_id, pipeline_id, log_time, level, stage, message"


@query(
    "runs_list",
    f"SELECT {RUN_COLUMNS}, {LISTED_METHOD_SQL} AS execution_method FROM runs "
    f"WHERE status = 'success' AND {LISTED_METHOD_SQL} = 'airflow' ORDER BY start_time DESC, pipeline_id LIMIT 100",
)
def runs_list(spark, sf_dir):
    return audit.list_runs(table(spark, sf_dir, "runs"), status="success", execution_method="airflow")


@query(
    "run_stats",
    f"SELECT {TOTALS_SQL}, count(*) FILTER (WHERE status = 'running') AS running_pipelines, {RATE_SQL} FROM runs",
)
def run_stats(spark, sf_dir):
    return audit.run_statistics(table(spark, sf_dir, "runs"))


@query(
    "run_stats_by_method",
    f"SELECT {LISTED_METHOD_SQL} AS execution_method, {TOTALS_SQL} FROM runs GROUP BY 1",
)
def run_stats_by_method(spark, sf_dir):
    return audit.run_statistics_by_method(table(spark, sf_dir, "runs"))


@query(
    "run_stats_by_spec",
    f"""
    SELECT metadata_name, {TOTALS_SQL},
      count(*) FILTER (WHERE {LISTED_METHOD_SQL} = 'direct') AS direct_runs,
      count(*) FILTER (WHERE {LISTED_METHOD_SQL} = 'airflow') AS airflow_runs,
      CAST(sum(valid_records) AS BIGINT) AS total_valid_records,
      CAST(sum(invalid_records) AS BIGINT) AS total_invalid_records,
      round(avg(coalesce(duration_seconds, 0)), 6) AS average_duration_seconds,
      max(start_time) AS last_run, {RATE_SQL}
    FROM runs GROUP BY metadata_name
    """,
)
def run_stats_by_spec(spark, sf_dir):
    stats = audit.run_statistics_by_spec(table(spark, sf_dir, "runs"))
    return stats.withColumn("average_duration_seconds", F.round("average_duration_seconds", 6))


@query(
    "run_enriched",
    """
    SELECT pipeline_id, start_time, end_time,
      CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1e6 AS duration_seconds,
      CASE WHEN total_records > 0 THEN CAST(valid_records AS DOUBLE) / total_records * 100 END AS valid_percentage
    FROM runs
    """,
)
def run_enriched(spark, sf_dir):
    enriched = audit.enrich_runs(table(spark, sf_dir, "runs"))
    return enriched.select("pipeline_id", "start_time", "end_time", "duration_seconds", "valid_percentage")


@query("status_breakdown", "SELECT status, count(*) AS n_runs FROM runs GROUP BY status")
def status_breakdown(spark, sf_dir):
    return audit.status_breakdown(table(spark, sf_dir, "runs"))


def _runs_with_stages(spark, sf_dir):
    """Runs of the log table, each with the stages its log mentions and one that logs nothing."""
    logs = table(spark, sf_dir, "logs")
    times = logs.groupBy("pipeline_id", "stage").agg(
        F.min("log_time").alias("start_time"), F.max("log_time").alias("end_time"), F.count(F.lit(1)).alias("n_lines")
    )
    stage = F.struct(
        F.coalesce("stage", F.lit("cleanup")).alias("name"),
        F.lit("success").alias("status"),
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.col("end_time").cast("timestamp").alias("end_time"),
        F.concat(F.lit("lines: "), F.col("n_lines").cast("string")).alias("data"),
    )
    # At most the four stages of a run are collected.
    return times.groupBy("pipeline_id").agg(F.collect_list(stage).alias("stages"))


STAGES_SQL = """
SELECT pipeline_id, coalesce(stage, 'cleanup') AS stage, 'success' AS status, min(log_time) AS start_time,
  max(log_time) AS end_time, 'lines: ' || CAST(count(*) AS VARCHAR) AS data FROM logs GROUP BY 1, 2
"""


@query(
    "stage_log_lines",
    f"""
    SELECT s.pipeline_id, s.stage, s.status, s.start_time, s.end_time, s.data, g.log_id, g.log_time, g.level, g.message
    FROM ({STAGES_SQL}) s LEFT JOIN logs g ON s.pipeline_id = g.pipeline_id AND s.stage = g.stage
    """,
)
def stage_log_lines(spark, sf_dir):
    lines = audit.stage_log_lines(_runs_with_stages(spark, sf_dir), table(spark, sf_dir, "logs"))
    return lines.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("start_time", "end_time")})


@query(
    "stage_detail",
    f"""
    SELECT s.pipeline_id, s.stage, s.status, s.data, coalesce(g.n_logs, 0) AS n_logs, coalesce((g.n - 1) // {LINES_A_PART}, 0) AS part,
      coalesce(string_agg(g.message, '; ' ORDER BY g.n), '') AS messages
    FROM ({STAGES_SQL}) s LEFT JOIN (
      SELECT *, row_number() OVER (PARTITION BY pipeline_id, stage ORDER BY log_time DESC, log_id) AS n,
        count(*) OVER (PARTITION BY pipeline_id, stage) AS n_logs FROM logs) g
    ON s.pipeline_id = g.pipeline_id AND s.stage = g.stage GROUP BY ALL
    """,
)
def stage_detail(spark, sf_dir):
    """Every stage of every run with all its lines, so many to a row."""
    logs = table(spark, sf_dir, "logs")
    detail = audit.stage_detail(_runs_with_stages(spark, sf_dir), logs, part_lines=LINES_A_PART)
    messages = F.array_join(F.col("logs.message"), "; ").alias("messages")
    return detail.select("pipeline_id", "stage", "status", "data", "n_logs", F.col("part").cast("bigint").alias("part"), messages)


@query(
    "logs_of_run",
    f"SELECT {LOG_COLUMNS} FROM logs WHERE pipeline_id = 'run_101' AND level = 'DEBUG' "
    "ORDER BY log_time DESC, log_id LIMIT 1000",
)
def logs_of_run(spark, sf_dir):
    return audit.logs_of_run(table(spark, sf_dir, "logs"), "run_101", level="DEBUG")


@query(
    "recent_errors",
    f"SELECT {LOG_COLUMNS} FROM logs WHERE level IN ('ERROR', 'CRITICAL') ORDER BY log_time DESC, log_id LIMIT 100",
)
def recent_errors(spark, sf_dir):
    return audit.recent_errors(table(spark, sf_dir, "logs"))


@query("log_retention", f"SELECT {LOG_COLUMNS} FROM logs WHERE log_time >= TIMESTAMP '2024-01-15 00:00:00'")
def log_retention(spark, sf_dir):
    return audit.retained_logs(table(spark, sf_dir, "logs"), datetime.datetime(2024, 2, 14), days=30)


def _logs_by_date(spark, sf_dir):
    """The log table as a run's history keeps it: files in folders by date."""
    path = StagingArea(spark).new_path("logs")
    logs = dated(table(spark, sf_dir, "logs"), "log_time", "log_date")
    write_sink(logs, Sink("logs", "logs", (path,), format="parquet", partition_by=("log_date",)))
    return spark.read.parquet(path)


@query("log_retention_files", f"SELECT {LOG_COLUMNS} FROM logs WHERE CAST(log_time AS DATE) >= DATE '2024-01-12'")
def log_retention_files(spark, sf_dir):
    """The days that are kept; older folders are not opened."""
    kept = audit.retained_files(_logs_by_date(spark, sf_dir), datetime.datetime(2024, 1, 19), days=7)
    return kept.select(*LOG_COLUMNS.split(", "))


@query(
    "log_expired_files",
    "SELECT CAST(log_time AS DATE) AS log_date, count(*) AS n_rows FROM logs WHERE CAST(log_time AS DATE) < DATE '2024-01-12' GROUP BY 1",
)
def log_expired_files(spark, sf_dir):
    """The days whose files have served their time."""
    expired = audit.expired_files(_logs_by_date(spark, sf_dir), datetime.datetime(2024, 1, 19), days=7)
    return expired.groupBy("log_date").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "text_search",
    f"SELECT {LOG_COLUMNS} FROM logs WHERE contains(lower(message), 'click') OR contains(lower(level), 'click') "
    "OR contains(lower(stage), 'click')",
)
def text_search(spark, sf_dir):
    return audit.search_logs(table(spark, sf_dir, "logs"), "CLICK")


@query(
    "text_search_runs",
    f"SELECT {RUN_COLUMNS} FROM runs WHERE contains(lower(pipeline_id), 'flow_12') "
    "OR contains(lower(metadata_name), 'flow_12')",
)
def text_search_runs(spark, sf_dir):
    return audit.search_runs(table(spark, sf_dir, "runs"), "Flow_12")
