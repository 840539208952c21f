"""Writers for the sinks of a spec."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordflow.errors import SpecError
from recordflow.functions.columns import known_columns
from recordflow.plans.spec import Sink
from recordflow.plans.staging import StagingArea
from recordflow.sources.readers import require_format

log = logging.getLogger(__name__)

# Partition values whose files a task holds open at once. Rows of these are written as they come; only with more values are the rest sorted.
OPEN_FILES = 8
OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def check_sink_columns(df: DataFrame, sink: Sink) -> None:
    """Partition columns must exist and leave at least one column for the files."""
    where = f"sink {sink.name!r}"
    require_format(df.sparkSession, sink.format, where)
    known_columns(df, sink.partition_by, where)
    if sink.partition_by and len(set(sink.partition_by)) >= len(df.columns):
        raise SpecError(f"{where}: partitionBy takes all columns {df.columns}")


def write_sink(df: DataFrame, sink: Sink, counter: Observation | None = None, stable: bool = False) -> None:
    """Write a frame to every path of a sink; ``counter`` receives the row count as ``n``.

    Directories are never created beforehand, so the modes ``error`` and ``ignore`` see the real
    state. A frame for several paths is staged once, so that all paths get the same rows, unless
    it is said to be ``stable``.
    """
    check_sink_columns(df, sink)
    if len(sink.paths) > 1 and not stable:
        area = StagingArea(df.sparkSession)
        try:
            return write_sink(area.stage(df, sink.name), sink, counter, stable=True)
        finally:
            area.discard()
    rebalance = bool(sink.partition_by) if sink.rebalance is None else sink.rebalance
    if rebalance:
        # Adaptive execution then cuts a hot partition value into files of the advisory size and
        # packs small ones together; without it every task would write a file per value.
        df = df.hint("rebalance", *sink.partition_by) if sink.partition_by else df.hint("rebalance")
    if counter is not None:
        # After the last shuffle: rows of a task that runs again are then counted once.
        df = df.observe(counter, F.count(F.lit(1)).alias("n"))
    options = dict(sink.options)
    if sink.format == "json":
        options.setdefault("ignoreNullFields", "false")
    if sink.overwrite_partitions:
        options["partitionOverwriteMode"] = "dynamic"
    with _open_files(df.sparkSession, 0 if rebalance or not sink.partition_by else OPEN_FILES):
        for path in sink.paths:
            writer = df.write.format(sink.format).mode(sink.mode).options(**options)
            if sink.partition_by:
                writer = writer.partitionBy(*sink.partition_by)
            writer.save(path)


@contextmanager
def _open_files(spark: SparkSession, n: int):
    """Let tasks hold ``n`` files open, unless the session says how many; a task's rows, which no shuffle has sized, then need no sort."""
    if not n or spark.conf.get(OPEN_FILES_CONF, None) is not None:
        yield
        return
    spark.conf.set(OPEN_FILES_CONF, str(n))
    try:
        yield
    finally:
        spark.conf.unset(OPEN_FILES_CONF)


def write_sinks(frames: Mapping[str, DataFrame], sinks: Sequence[Sink]) -> dict[str, bool]:
    """Write all sinks in order and report which succeeded, instead of stopping at the first error.

    A frame with several writes is staged once before them.
    """
    writes = Counter(sink.input for sink in sinks for _ in sink.paths)
    done, staged = {}, {}
    areas = []
    try:
        for sink in sinks:
            try:
                if writes[sink.input] > 1 and sink.input not in staged:
                    areas.append(StagingArea(frames[sink.input].sparkSession))
                    staged[sink.input] = areas[-1].stage(frames[sink.input], sink.input)
                write_sink(staged.get(sink.input, frames[sink.input]), sink, stable=sink.input in staged)
                done[sink.name] = True
            except Exception:
                log.exception("sink %s failed", sink.name)
                done[sink.name] = False
    finally:
        for area in areas:
            area.discard()
    return done


def snapshot(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet copy of a table."""
    df.write.mode("overwrite").parquet(path)
