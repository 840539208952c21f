"""Session settings that flows run better with, and the session of a spec."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

from recordflow.plans.spec import Dataflow

TUNING = {
    # The JVM never compiles a method of more than 8000 bytes. A validation with many rules can
    # generate such a method, and then runs several times slower than the same work split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Split a hot join key even where that costs another shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Staged tables are packed, so the usual 128 MB of one can hold more rows than a task sorts in memory.
    "spark.sql.files.maxPartitionBytes": "32m",
}


@contextmanager
def tuned(spark: SparkSession):
    """The settings for the time of a run, except those the session sets itself."""
    missing = [key for key in TUNING if spark.conf.get(key, None) is None]
    for key in missing:
        spark.conf.set(key, TUNING[key])
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def session_for(flow: Dataflow) -> SparkSession:
    """A session with the app name, master and conf of the spec's settings."""
    settings = flow.settings.spark
    builder = SparkSession.builder.appName(settings.get("app_name", "recordflow"))
    if settings.get("master"):
        builder = builder.master(settings["master"])
    for key, value in {**TUNING, **(settings.get("config") or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
