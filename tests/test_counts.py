"""Counts of a run: exact whatever tells them, also when tasks run twice."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordflow.functions.fields import FieldRegistry
from recordflow.plans import flow as flows
from recordflow.plans.flow import CompiledFlow
from recordflow.plans.staging import StagingArea


def spec(tmp_path, steps, source="JSON", sink="out", **settings):
    return {
        "version": "1.0.0",
        "dataflows": [
            {
                "name": "f",
                "sources": [{"name": "s", "path": str(tmp_path / "in"), "format": source}],
                "transformations": steps,
                "sinks": [{"input": steps[-1]["name"] if steps else "s", "name": sink, "paths": [str(tmp_path / "out")], "format": "PARQUET", "saveMode": "OVERWRITE"}],
                "settings": settings,
            }
        ],
    }


def counted(report):
    return {item["name"]: item.get("record_count", item.get("input_counts")) for s in report.stages for item in s["data"]}


ADDED = {"name": "added", "type": "add_fields", "params": {"input": "s", "addFields": [{"name": "x", "function": "literal", "value": 1}]}}
TOTALS = {"name": "totals", "type": "aggregate", "params": {"input": "added", "groupBy": ["k"], "aggregations": [{"column": "id", "function": "count", "alias": "n"}]}}
FILTER = {"name": "some", "type": "filter", "params": {"input": "s", "condition": "id < 10"}}


@pytest.fixture
def no_observations(monkeypatch):
    """Counts must come from elsewhere."""
    monkeypatch.setattr(flows, "observed", lambda _: pytest.fail("asked for an observed count"))


def test_footers_count_a_columnar_source_before_a_filter(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    report = CompiledFlow(spark, spec(tmp_path, [FILTER], "PARQUET")).run()
    assert counted(report) == {"s": 1000, "some": [1000], "out": 10}


def test_a_row_format_source_before_a_filter_is_not_counted(spark, tmp_path):
    spark.range(1000).write.json(str(tmp_path / "in"))
    report = CompiledFlow(spark, spec(tmp_path, [FILTER])).run()
    assert counted(report) == {"s": None, "some": [None], "out": 10}


def test_a_sink_counts_what_leads_to_it_row_by_row(spark, tmp_path):
    spark.range(300).write.json(str(tmp_path / "in"))
    compiled = CompiledFlow(spark, spec(tmp_path, [ADDED]))
    report = compiled.run()
    assert counted(report) == {"s": 300, "added": [300], "out": 300}


def test_a_union_counts_as_its_parts(spark, tmp_path, no_observations, monkeypatch):
    """Sources by their footers, and the sum of both."""
    monkeypatch.setattr(flows._Run, "_write", lambda self, sink, position: flows.write_sink(self.frames[position], sink) or {"name": sink.name, "record_count": 0})
    spark.range(20).write.parquet(str(tmp_path / "in"))
    both = {"name": "both", "type": "union", "params": {"inputs": ["s", "s"]}}
    after = {"name": "last", "type": "filter", "params": {"input": "both", "condition": "id > 3"}}
    assert counted(CompiledFlow(spark, spec(tmp_path, [both, after], "PARQUET")).run())["last"] == [40]


def test_counts_of_a_run_whose_tasks_ran_twice(spark, tmp_path, monkeypatch):
    """Files of a shuffle get lost once they are counted, so the tasks before it run again."""
    mark = str(tmp_path / "lost")
    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    @F.pandas_udf("bigint")
    def losing(n: pd.Series) -> pd.Series:
        try:
            os.close(os.open(mark, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return n
        for folder in folders:
            for path, _, names in os.walk(folder):
                for name in names:
                    if name.startswith("shuffle_"):
                        os.remove(os.path.join(path, name))
        return n

    fields = FieldRegistry()
    fields.register("losing", lambda df, params: losing(F.col("n")))
    after = {"name": "after", "type": "add_fields", "params": {"input": "totals", "addFields": [{"name": "n2", "function": "losing"}]}}
    source = spark.range(0, 5000, 1, 6).selectExpr("id", "id % 97 AS k")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compiled = CompiledFlow(spark, spec(tmp_path, [ADDED, TOTALS, after]), fields=fields, inputs={"s": source})
        reruns = []
        plain_rerun = StagingArea.has_rerun_tasks
        monkeypatch.setattr(StagingArea, "has_rerun_tasks", lambda self: reruns.append(plain_rerun(self)) or reruns[-1])
        report = compiled.run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert os.path.exists(mark) and any(reruns)
    assert counted(report) == {"s": 5000, "added": [5000], "totals": [5000], "after": [97], "out": 97}


def test_the_callers_job_group_is_put_back(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "mine")
    try:
        CompiledFlow(spark, spec(tmp_path, [ADDED], "PARQUET")).run()
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
