"""What is known about one run, and its form as audit rows."""

from __future__ import annotations

import datetime
import json
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.operators.quality import Gate
from recordflow.plans.spec import Dataflow

STAGE_TYPE = "struct<name:string,status:string,start_time:timestamp,end_time:timestamp,data:string>"
RUNS_SCHEMA = (
    "pipeline_id string, metadata_name string, status string, start_time timestamp, end_time timestamp, "
    "duration_seconds double, total_records bigint, valid_records bigint, invalid_records bigint, "
    f"valid_percentage double, stages array<{STAGE_TYPE}>, error_message string"
)
LOGS_SCHEMA = (
    "log_id string, pipeline_id string, log_time timestamp, level string, stage string, message string, "
    "details string"
)


@dataclass
class RunReport:
    pipeline_id: str
    metadata_name: str
    metadata_version: str
    start_time: datetime.datetime
    status: str = "running"
    end_time: datetime.datetime | None = None
    error_message: str | None = None
    stages: list[dict[str, Any]] = field(default_factory=list)
    quality: list[dict[str, Any]] = field(default_factory=list)
    gates: list[Gate] = field(default_factory=list)

    @staticmethod
    def start(pipeline_id: str, flow: Dataflow, version: str) -> RunReport:
        return RunReport(pipeline_id, flow.name, version, _now())

    def finish(self, status: str, error: str | None = None) -> None:
        self.status, self.error_message, self.end_time = status, error, _now()

    @property
    def duration_seconds(self) -> float | None:
        return None if self.end_time is None else (self.end_time - self.start_time).total_seconds()

    @contextmanager
    def stage(self, name: str):
        """Time a stage; the list it yields collects the details of the stage."""
        entry = {"name": name, "status": "running", "start_time": _now(), "end_time": None, "data": []}
        self.stages.append(entry)
        try:
            yield entry["data"]
            entry["status"] = "success"
        except Exception:
            entry["status"] = "failed"
            raise
        finally:
            entry["end_time"] = _now()

    def add_quality(self, step: str, measured: dict[str, Any]) -> None:
        self.quality.append({"step": step, **measured})

    def as_dict(self) -> dict[str, Any]:
        return {
            "pipeline_id": self.pipeline_id,
            "metadata_name": self.metadata_name,
            "metadata_version": self.metadata_version,
            "status": self.status,
            "start_time": self.start_time,
            "end_time": self.end_time,
            "duration_seconds": self.duration_seconds,
            "error_message": self.error_message,
            "quality_metrics": self.quality,
            "gates": [asdict(gate) for gate in self.gates],
            "stages": self.stages,
        }

    def to_json(self) -> str:
        return json.dumps(self.as_dict(), default=str)

    def write(self, spark: SparkSession, path: str, mode: str = "error") -> None:
        """Write the report as one JSON document."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode(mode).text(path)

    def run_row(self, spark: SparkSession) -> DataFrame:
        """The run as one audit row; counts are those of the last validation."""
        measured = self.quality[-1] if self.quality else {}
        stages = [
            (stage["name"], stage["status"], stage["start_time"], stage["end_time"], _json(stage["data"]))
            for stage in self.stages
        ]
        row = (
            self.pipeline_id,
            self.metadata_name,
            self.status,
            self.start_time,
            self.end_time,
            self.duration_seconds,
            measured.get("total_records"),
            measured.get("valid_records"),
            measured.get("invalid_records"),
            measured.get("valid_percentage"),
            stages,
            self.error_message,
        )
        return spark.createDataFrame([row], RUNS_SCHEMA)

    def log_rows(self, spark: SparkSession) -> DataFrame:
        """One audit log line per stage, per gate and for the end of the run."""
        lines = []
        for stage in self.stages:
            level = "INFO" if stage["status"] == "success" else "ERROR"
            text = f"{stage['name']}: {stage['status']}"
            lines.append((stage["end_time"], level, stage["name"], text, _json(stage["data"])))
        for gate in self.gates:
            level = "INFO" if gate.passed else "ERROR"
            lines.append((self.end_time, level, "quality_check", gate.message, _json(asdict(gate))))
        if self.status == "failed":
            lines.append((self.end_time, "ERROR", "failure", f"Run failed: {self.error_message}", None))
        else:
            lines.append((self.end_time, "INFO", "completion", "Run completed successfully", None))
        rows = [
            (f"{self.pipeline_id}_{position:04d}", self.pipeline_id, *line)
            for position, line in enumerate(lines)
        ]
        return spark.createDataFrame(rows, LOGS_SCHEMA)

    def append_audit(self, spark: SparkSession, runs_path: str, logs_path: str) -> None:
        """Append the run and its log lines to Parquet audit tables, in folders by UTC date: ``run_date`` and ``log_date``."""
        for rows, time, date, path in (
            (self.run_row(spark), "start_time", "run_date", runs_path),
            (self.log_rows(spark), "log_time", "log_date", logs_path),
        ):
            dated_rows = dated(rows, time, date).coalesce(1)
            dated_rows.write.mode("append").partitionBy(date).parquet(path)


def dated(rows: DataFrame, time: str, date: str) -> DataFrame:
    """The rows with the UTC date of a time, whatever the session's zone."""
    if isinstance(rows.schema[time].dataType, T.TimestampNTZType):
        return rows.withColumn(date, F.to_date(time))
    return rows.withColumn(date, F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int")))


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def _json(value) -> str:
    return json.dumps(value, default=str)
