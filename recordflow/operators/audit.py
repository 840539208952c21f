"""Questions about run and log history, over audit tables of any size.

Runs have the columns of ``plans.report.RUNS_SCHEMA`` and logs those of ``LOGS_SCHEMA``. A
listing takes its newest rows after all filters, with the id as the tie-breaker, so that the
same tables always give the same rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.operators.windows import window
from recordflow.plans.staging import StagingArea

ERROR_LEVELS = ("ERROR", "CRITICAL")

# Lines of a stage that stand in one row of its detail.
PART_LINES = 10_000


def list_runs(
    runs: DataFrame,
    status: str | None = None,
    metadata_name: str | None = None,
    execution_method: str | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """The newest runs that meet every given filter."""
    runs = runs.withColumn("execution_method", _listed_method())
    runs = _where(runs, status=status, metadata_name=metadata_name, execution_method=execution_method)
    return _first(runs.orderBy(F.col("start_time").desc(), "pipeline_id"), limit)


def run_statistics(runs: DataFrame) -> DataFrame:
    """One row of totals by outcome, with the success rate in percent."""
    return _with_success_rate(
        runs.agg(
            *_totals(),
            F.count_if(F.col("status") == "running").alias("running_pipelines"),
        )
    )


def run_statistics_by_method(runs: DataFrame) -> DataFrame:
    """Totals for runs whose id says how they were started."""
    method = F.when(F.startswith("pipeline_id", F.lit("direct_")), "direct").when(
        F.startswith("pipeline_id", F.lit("airflow_")), "airflow"
    )
    known = runs.withColumn("execution_method", method).filter("execution_method IS NOT NULL")
    return known.groupBy("execution_method").agg(*_totals())


def run_statistics_by_spec(runs: DataFrame) -> DataFrame:
    """Totals per spec; the mean duration is over all runs, an unfinished one counting as 0."""
    grouped = runs.groupBy("metadata_name").agg(
        *_totals(),
        F.count_if(F.startswith("pipeline_id", F.lit("direct_"))).alias("direct_runs"),
        F.count_if(F.startswith("pipeline_id", F.lit("airflow_"))).alias("airflow_runs"),
        F.coalesce(F.sum("valid_records"), F.lit(0)).alias("total_valid_records"),
        F.coalesce(F.sum("invalid_records"), F.lit(0)).alias("total_invalid_records"),
        F.avg(F.coalesce("duration_seconds", F.lit(0.0))).alias("average_duration_seconds"),
        F.max("start_time").alias("last_run"),
    )
    return _with_success_rate(grouped)


def enrich_runs(runs: DataFrame) -> DataFrame:
    """Duration from start and end, and the valid percentage, both NULL where unknown."""
    seconds = (F.unix_micros(_instant("end_time")) - F.unix_micros(_instant("start_time"))) / F.lit(1e6)
    percentage = F.when(F.col("total_records") > 0, F.col("valid_records") / F.col("total_records") * 100)
    return runs.withColumns({"duration_seconds": seconds, "valid_percentage": percentage})


def status_breakdown(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))


def stage_log_lines(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """One row per stage and log line of that stage; a stage without log lines has one row.

    An inner join and the stages without a match, rather than an outer join, because a run with
    very many log lines can be split over tasks only in an inner join.
    """
    stages = _stages(runs)
    key = ["pipeline_id", "stage"]
    lines = logs.select(*key, "log_id", "log_time", "level", "message")
    silent = stages.join(logs.select(*key).distinct(), key, "left_anti")
    return stages.join(lines, key).unionByName(silent, allowMissingColumns=True)


def stage_detail(
    runs: DataFrame, logs: DataFrame, part_lines: int = PART_LINES, area: StagingArea | None = None, **options
) -> DataFrame:
    """Each stage with all its log lines, newest first, in parts of at most ``part_lines``.

    ``n_logs`` counts the stage's lines, which stand in as many rows as it takes, by ``part`` from 0 on; a stage without
    lines has one row. Lines are numbered by the window operator, which spreads a stage with very many of them (``hotRows`` in
    the options says how many that is), so no log meets in one task.
    """
    key = ["pipeline_id", "stage"]
    lines = logs.filter("pipeline_id IS NOT NULL AND stage IS NOT NULL").select(*key, "log_id", "log_time", "level", "message")
    newest = [{"column": "log_time", "desc": True}, "log_id"]
    numbered = window(lines, {"function": "row_number", "partitionBy": key, "orderBy": newest, "alias": "__position", **options}, area)
    line = F.struct("__position", "log_time", "level", "message")
    parts = (
        numbered.withColumn("part", F.expr(f"(__position - 1) div {int(part_lines)}"))
        .groupBy(*key, "part")
        .agg(F.transform(F.array_sort(F.collect_list(line)), lambda item: item.dropFields("__position")).alias("logs"))
    )
    counted = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("n_logs"))
    stages = _stages(runs)
    joined = stages.join(counted, key, "left").join(parts, key, "left")
    none = F.array().cast(parts.schema["logs"].dataType)
    return joined.withColumns(
        {"n_logs": F.coalesce("n_logs", F.lit(0)), "part": F.coalesce("part", F.lit(0)), "logs": F.coalesce("logs", none)}
    )


def logs_of_run(
    logs: DataFrame, pipeline_id: str, level: str | None = None, stage: str | None = None, limit: int | None = 1000
) -> DataFrame:
    """The newest log lines of one run."""
    return _newest(_where(logs, pipeline_id=pipeline_id, level=level, stage=stage), limit)


def recent_errors(logs: DataFrame, limit: int | None = 100) -> DataFrame:
    return _newest(logs.filter(F.col("level").isin(*ERROR_LEVELS)), limit)


def retained_logs(logs: DataFrame, now: datetime.datetime, days: int = 30, date_column: str = "log_date") -> DataFrame:
    """The log lines young enough to keep. Nothing is deleted in place.

    Of a table with a date partition, only the partitions that can hold such lines are read.
    """
    cutoff = now - datetime.timedelta(days=days)
    literal = F.lit(cutoff.isoformat()).cast(logs.schema["log_time"].dataType)
    kept = logs.filter(F.col("log_time") >= literal)
    # A day earlier, since a line's date is that of UTC, and the cutoff may be told in another zone.
    day = cutoff.date() - datetime.timedelta(days=1)
    return kept.filter(F.col(date_column) >= F.lit(day)) if date_column in logs.columns else kept


def retained_files(logs: DataFrame, now: datetime.datetime, days: int = 7, date_column: str = "log_date") -> DataFrame:
    """The rows of those files of a history by date that are young enough to keep, whole days at a time."""
    return logs.filter(F.col(date_column) >= F.lit((now - datetime.timedelta(days=days)).date()))


def expired_files(logs: DataFrame, now: datetime.datetime, days: int = 7, date_column: str = "log_date") -> DataFrame:
    """(date, file_path, file_size, n_rows) of the other files, for whoever may delete them.

    Only names and footers of the old partitions are read, no column.
    """
    old = logs.filter(F.col(date_column) < F.lit((now - datetime.timedelta(days=days)).date()))
    found = old.select(date_column, "_metadata.file_path", "_metadata.file_size")
    return found.groupBy(date_column, "file_path", "file_size").agg(F.count(F.lit(1)).alias("n_rows"))


def search_runs(runs: DataFrame, text: str) -> DataFrame:
    """Runs whose id or spec name holds the text, whatever the case."""
    return runs.filter(_holds("pipeline_id", text) | _holds("metadata_name", text))


def search_logs(logs: DataFrame, text: str) -> DataFrame:
    """Log lines whose message, level or stage holds the text, whatever the case."""
    return logs.filter(_holds("message", text) | _holds("level", text) | _holds("stage", text))


def _where(df: DataFrame, **values) -> DataFrame:
    for name, value in values.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def _newest(logs: DataFrame, limit: int | None) -> DataFrame:
    return _first(logs.orderBy(F.col("log_time").desc(), "log_id"), limit)


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    ]


def _with_success_rate(totals: DataFrame) -> DataFrame:
    rate = F.when(F.col("total_runs") > 0, F.col("successful_runs") / F.col("total_runs") * 100)
    return totals.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def _listed_method() -> Column:
    return F.when(F.startswith("pipeline_id", F.lit("airflow_")), "airflow").otherwise("direct")


def _stages(runs: DataFrame) -> DataFrame:
    stage = runs.select("pipeline_id", F.explode("stages").alias("item"))
    has_data = "data" in stage.schema["item"].dataType.names
    return stage.select(
        "pipeline_id",
        F.col("item.name").alias("stage"),
        F.coalesce("item.status", F.lit("unknown")).alias("status"),
        F.col("item.start_time").alias("start_time"),
        F.col("item.end_time").alias("end_time"),
        (F.col("item.data") if has_data else F.lit(None).cast("string")).alias("data"),
    )


def _instant(name: str) -> Column:
    return F.col(name).cast("timestamp")


def _holds(name: str, text: str) -> Column:
    return F.contains(F.lower(name), F.lit(text.lower()))
