import datetime

import pytest
from pyspark.sql import functions as F

from recordflow.operators import audit
from recordflow.plans.report import RUNS_SCHEMA, dated
from tests.conftest import rows

T0 = datetime.datetime(2025, 1, 1)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def stage(name, status="success"):
    return (name, status, T0, T0, "[]")


@pytest.fixture(scope="module")
def runs(spark):
    def run(name, spec, status, minute, seconds, counts=(None, None, None), stages=()):
        end = None if seconds is None else at(minute) + datetime.timedelta(seconds=seconds)
        return (name, spec, status, at(minute), end, seconds, *counts, None, list(stages), None)

    return spark.createDataFrame(
        [
            run("direct_1", "Motor", "success", 1, 10.0, (10, 8, 2), [stage("ingestion"), stage("storage")]),
            run("airflow_2", "Motor", "failed", 2, 20.0, (4, 1, 3), [stage("ingestion", None)]),
            run("direct_3", "Home", "running", 3, None),
            run("other_4", "Home", "success", 3, 30.0, (0, 0, 0)),
        ],
        RUNS_SCHEMA,
    )


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(
        [
            (1, "direct_1", at(1), "INFO", "ingestion", "Read files"),
            (2, "direct_1", at(2), "ERROR", "ingestion", "Slow disk"),
            (3, "direct_1", at(3), "DEBUG", None, "note"),
            (4, "airflow_2", at(2), "CRITICAL", "ingestion", "Lost node"),
            (5, "nobody", at(9), "WARNING", "storage", "x"),
        ],
        "log_id long, pipeline_id string, log_time timestamp, level string, stage string, message string",
    )


def ids(df, name="pipeline_id"):
    return [row[name] for row in df.collect()]


def test_listing_filters_before_it_limits(runs):
    assert ids(audit.list_runs(runs)) == ["direct_3", "other_4", "airflow_2", "direct_1"]
    assert ids(audit.list_runs(runs, limit=1)) == ["direct_3"]
    assert ids(audit.list_runs(runs, execution_method="airflow", limit=1)) == ["airflow_2"]
    assert ids(audit.list_runs(runs, status="success", metadata_name="Motor")) == ["direct_1"]


def test_statistics(runs):
    assert rows(audit.run_statistics(runs)) == [(4, 2, 1, 1, 50.0)]
    assert rows(audit.run_statistics(runs.filter("false"))) == [(0, 0, 0, 0, 0.0)]
    assert rows(audit.run_statistics_by_method(runs)) == [("airflow", 1, 0, 1), ("direct", 2, 1, 0)]
    names = ("metadata_name", "total_runs", "success_rate", "direct_runs", "airflow_runs", "total_valid_records",
             "total_invalid_records", "average_duration_seconds", "last_run")
    assert rows(audit.run_statistics_by_spec(runs), *names) == [
        ("Home", 2, 50.0, 1, 0, 0, 0, 15.0, at(3)),
        ("Motor", 2, 50.0, 1, 1, 9, 5, 15.0, at(2)),
    ]
    assert rows(audit.status_breakdown(runs)) == [("failed", 1), ("running", 1), ("success", 2)]


def test_enrichment(runs):
    enriched = audit.enrich_runs(runs)
    assert rows(enriched, "pipeline_id", "duration_seconds", "valid_percentage") == [
        ("airflow_2", 20.0, 25.0), ("direct_1", 10.0, 80.0), ("direct_3", None, None), ("other_4", 30.0, None),
    ]


def test_stage_detail(runs, logs):
    detail = audit.stage_detail(runs, logs)
    found = {
        (r["pipeline_id"], r["stage"], r["status"], r["n_logs"], r["part"]): [line["message"] for line in r["logs"]]
        for r in detail.collect()
    }
    assert found == {
        ("direct_1", "ingestion", "success", 2, 0): ["Slow disk", "Read files"],
        ("direct_1", "storage", "success", 0, 0): [],
        ("airflow_2", "ingestion", "unknown", 1, 0): ["Lost node"],
    }


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_stage_detail_is_whole_in_parts(spark, area, hot_rows):
    """One stage has nearly all lines, whether its log is spread or not."""
    runs = spark.sql("SELECT 'r' AS pipeline_id, array(named_struct('name', 's', 'status', 'ok', 'start_time', now(), 'end_time', now(), 'data', '{}')) AS stages")
    runs = runs.unionByName(runs.withColumn("pipeline_id", F.lit("q")))
    logs = spark.range(0, 2500, 1, 7).selectExpr(
        "id AS log_id", "IF(id % 500 = 0, 'q', 'r') AS pipeline_id", "timestamp_micros(id * 7919 % 1000) AS log_time",
        "'INFO' AS level", "'s' AS stage", "string(id) AS message",
    )
    detail = audit.stage_detail(runs, logs, part_lines=64, area=area, hotRows=hot_rows).collect()
    assert {(r["pipeline_id"], r["n_logs"]) for r in detail} == {("r", 2495), ("q", 5)}
    parts = sorted((r["part"], [int(line["message"]) for line in r["logs"]]) for r in detail if r["pipeline_id"] == "r")
    assert [len(ids) for _, ids in parts] == [64] * 38 + [63]
    wanted = sorted((i for i in range(2500) if i % 500), key=lambda i: (-(i * 7919 % 1000), i))
    assert [i for _, ids in parts for i in ids] == wanted


def test_stage_log_lines(runs, logs):
    assert rows(audit.stage_log_lines(runs, logs), "pipeline_id", "stage", "log_id") == [
        ("airflow_2", "ingestion", 4), ("direct_1", "ingestion", 1), ("direct_1", "ingestion", 2),
        ("direct_1", "storage", None),
    ]


def test_logs(logs):
    assert ids(audit.logs_of_run(logs, "direct_1"), "log_id") == [3, 2, 1]
    assert ids(audit.logs_of_run(logs, "direct_1", stage="ingestion", limit=1), "log_id") == [2]
    assert ids(audit.logs_of_run(logs, "direct_1", level="INFO"), "log_id") == [1]
    assert ids(audit.recent_errors(logs), "log_id") == [2, 4]
    assert ids(audit.recent_errors(logs, limit=1), "log_id") == [2]


def test_retention(logs):
    kept = audit.retained_logs(logs, at(2) + datetime.timedelta(days=30))
    assert sorted(ids(kept, "log_id")) == [2, 3, 4, 5]


def test_retention_by_date(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    logs = logs.withColumn("log_time", F.expr("log_time + make_interval(0, 0, 0, int(log_id) div 2)"))
    with_dates = dated(logs, "log_time", "log_date")
    with_dates.write.partitionBy("log_date").parquet(path)
    history = spark.read.parquet(path)
    days = sorted(r["log_date"] for r in with_dates.select("log_date").distinct().collect())
    assert history.schema["log_date"].dataType.typeName() == "date" and history.count() == logs.count()
    cutoff = datetime.datetime.combine(days[-1], datetime.time(12))
    kept = audit.retained_files(history, cutoff + datetime.timedelta(days=7))
    old = audit.expired_files(history, cutoff + datetime.timedelta(days=7))
    assert kept.count() == with_dates.filter(F.col("log_date") == days[-1]).count()
    assert kept.count() + sum(r["n_rows"] for r in old.collect()) == logs.count()
    assert all(f"log_date={r['log_date']}" in r["file_path"] and r["file_size"] > 0 for r in old.collect())
    newest = max(r["log_time"] for r in logs.collect())
    by_time = audit.retained_logs(history, newest + datetime.timedelta(days=30))
    assert [r["log_time"] for r in by_time.collect()] == [newest]
    for df in (kept, by_time):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(log_date" in plan and "log_date#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_search(runs, logs):
    assert sorted(ids(audit.search_runs(runs, "mOTOR"))) == ["airflow_2", "direct_1"]
    assert sorted(ids(audit.search_runs(runs, "_3"))) == ["direct_3"]
    assert sorted(ids(audit.search_logs(logs, "STORAGE"), "log_id")) == [5]
    assert sorted(ids(audit.search_logs(logs, "o"), "log_id")) == [1, 2, 3, 4, 5]
    assert audit.search_logs(logs, "%").count() == 0
