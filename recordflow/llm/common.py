"""Helpers that several operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.plans.staging import StagingArea

#: Bytes that a Python worker gets at once; Spark's default holds several copies of long texts at a time.
BATCH_CONF, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one step of a vectorised function works on, unless one text is longer.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs whose frames nobody holds any more.

    They go when the driver's JVM collects its garbage. The bridge to Python lets go of unused
    frames now and then only, so that is asked for a few times.
    """
    gc.collect()
    for _ in range(3):
        time.sleep(1.2)
        spark._jvm.System.gc()


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    It cuts the lineage and gives later joins a known size.
    """
    return StagingArea(df.sparkSession).stage(df, label)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and all other columns together as the struct ``row``, out of the way of other names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in columns]
    return docs.select(F.struct(*(others or [F.lit(True).alias("none")])).alias("row"), *columns)


def unpacked(rows: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns of a packed frame by their names before, some of them changed."""
    inside = set(rows.schema["row"].dataType.names)
    return rows.select(*[(changed[n] if n in changed else F.col(f"row.`{n}`" if n in inside else f"`{n}`")).alias(n) for n in names])


def handed_back() -> None:
    """Return the memory of a finished task: workers stay for other stages, and what a library keeps for itself would add up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` in batches small enough for long texts, unless the session has set a size of its own."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF) == DEFAULT_BATCH:
        conf.set(BATCH_CONF, BATCH_BYTES)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            handed_back()

    return df.mapInArrow(whole, schema)


def words(text: Column) -> Column:
    """The words of a text, which no space or control white space divides; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
