"""Readers for the file formats of a spec, and the check of an input folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.errors import SpecError
from recordflow.plans.spec import Source

AVRO_PACKAGE = "org.apache.spark:spark-avro"


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """A lazy frame over the source. Give ``schema`` to save the pass that infers it."""
    require_format(spark, source.format, f"source {source.name!r}")
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema:
        reader = reader.schema(source.schema)
    path = source.path if isinstance(source.path, str) else list(source.path)
    return reader.load(path)


def read_sources(spark: SparkSession, sources: Sequence[Source]) -> Mapping[str, DataFrame]:
    return {source.name: read_source(spark, source) for source in sources}


def preflight(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """One row per matching input file: path, name, length and modification time.

    Contents are not read. A folder that does not exist is an error of the reader.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file_name"), "length", F.col("modificationTime").alias("modified"))


def require_input(spark: SparkSession, path: str, pattern: str = "*.json") -> int:
    """The number of matching input files; none at all is an error."""
    try:
        count = preflight(spark, path, pattern).count()
    except AnalysisException as error:
        raise FileNotFoundError(f"input folder not found: {path}") from error
    if count == 0:
        raise FileNotFoundError(f"no file matches {pattern} in {path}")
    return count


def require_format(spark: SparkSession, name: str, where: str) -> None:
    if name == "avro" and not _has_avro(spark):
        raise SpecError(f"{where}: format avro needs the package {AVRO_PACKAGE} of this Spark version")


@cache
def _has_avro(spark: SparkSession) -> bool:
    try:
        spark.read.format("avro").schema("probe INT").load([])
    except AnalysisException as error:
        return "Failed to find data source" not in str(error)
    return True
