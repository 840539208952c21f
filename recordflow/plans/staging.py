"""Staged tables: results written once to shared storage and read back.

A staged table cuts the lineage, so a lost executor can only cost a re-read, never a
recomputation that gives other values (uuids, the survivor of an unordered dedupe).
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from recordflow.errors import SpecError

CHECKPOINT_CONF = "spark.checkpoint.dir"
JOB_GROUP = "spark.jobGroup.id"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    root = root or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise SpecError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="recordflow-"))
    return context.getCheckpointDir().rstrip("/")


class StagingArea:
    """A folder of staged tables that belongs to one run.

    Tables behind lazy frames must outlive the call that made them: what nobody has discarded goes
    when the program ends, if its session still runs then. Tables have the session's Parquet codec unless ``compression`` names one.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None, compression: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.compression = compression
        self._count = 0

    @property
    def path(self) -> str:
        return f"{checkpoint_root(self.spark)}/recordflow/{self.run_id}"

    def new_path(self, label: str) -> str:
        folder = self.path
        self._count += 1
        _LEFT.add(self)
        return f"{folder}/{self._count:03d}_{re.sub('[^A-Za-z0-9_]', '_', label)}"

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` as Parquet and return the table read back with the same schema."""
        path = self.new_path(label)
        df.write.parquet(path, compression=self.compression)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def watched(self):
        """Mark the jobs that are started meanwhile as this run's, so that it can ask about their tasks."""
        context = self.spark.sparkContext
        before = context.getLocalProperty(JOB_GROUP)
        context.setLocalProperty(JOB_GROUP, self.run_id)
        try:
            yield
        finally:
            context.setLocalProperty(JOB_GROUP, before)

    def has_rerun_tasks(self) -> bool:
        """Whether a task of the run's jobs was done more than once, after a failure, a loss of its output or as a precaution.

        Stages that were skipped, as their output was there, have no tasks to ask about.
        """
        tracker = self.spark.sparkContext.statusTracker()
        jobs = filter(None, map(tracker.getJobInfo, tracker.getJobIdsForGroup(self.run_id)))
        stages = filter(None, (tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds))
        return any(s.currentAttemptId or s.numFailedTasks or s.numCompletedTasks > s.numTasks for s in stages)

    def discard(self) -> None:
        """Delete this run's own staged tables."""
        _LEFT.discard(self)
        if self._count == 0:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# Areas that hold tables.
_LEFT: set[StagingArea] = set()


@atexit.register
def _discard_left() -> None:
    for area in list(_LEFT):
        try:
            if area.spark.sparkContext._jsc is not None:
                area.discard()
        except Exception:  # the session is gone, and with it the way to its files
            return


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame; it is the file size for a plain scan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


_TIME_OF_QUERY = re.compile(r"\b(current_timestamp|current_date|current_time|localtimestamp|now)\(", re.IGNORECASE)


def is_repeatable(df: DataFrame) -> bool:
    """Whether a frame gives the same values when it is computed again from the same files."""
    analysed = df._jdf.queryExecution().analyzed()
    return bool(analysed.deterministic()) and not _TIME_OF_QUERY.search(analysed.toString())
