"""Row-wise steps: computed fields, renames, drops, selections and filters."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.columns import TEMPORAL, column_of, known_columns, type_of
from recordflow.functions.fields import LOOKUP_JOIN_ENTRIES, RUN_TIME, FieldRegistry, lookup_entries

# A mapping comes from the spec, so its size is known before anything is sent; beyond this many
# entries the join is left to Spark instead of being broadcast.
LOOKUP_BROADCAST_ENTRIES = 200_000


def add_fields(
    df: DataFrame, params: Mapping[str, Any], registry: FieldRegistry | None = None, run_time=None
) -> DataFrame:
    """Add computed fields in declared order; a later field may use an earlier one.

    Fields are added in batches, each one projection. A batch ends where a field could read a
    name that the batch itself defines.
    """
    registry = registry or FieldRegistry()
    batch: dict[str, Any] = {}
    for config in params.get("addFields") or []:
        for key in ("name", "function"):
            if key not in config:
                raise SpecError(f"field without '{key}': {config}")
        name, function = config["name"], config["function"]
        build = registry.get(function)
        if batch and (not registry.is_built_in(function) or _may_read(config, batch)):
            df, batch = df.withColumns(batch), {}
        if function == "lookup" and len(config.get("mapping") or {}) > LOOKUP_JOIN_ENTRIES:
            df, batch = df.withColumns(batch) if batch else df, {}
            df = _lookup_join(df, config)
            continue
        arguments = dict(config) if run_time is None else {**config, RUN_TIME: run_time}
        batch[name] = build(df, arguments)
    return df.withColumns(batch) if batch else df


def rename_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Rename one after another, resolved into a single projection."""
    names = list(df.columns)
    for old, new in (params.get("mapping") or {}).items():
        hits = [position for position, name in enumerate(names) if name.lower() == old.lower()]
        if not hits and params.get("onMissing") != "skip":
            raise SpecError(f"rename_columns: no column {old!r}; known: {names}")
        for position in hits:
            names[position] = new
    if len({name.lower() for name in names}) != len(names):
        raise SpecError(f"rename_columns gives repeated names: {names}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    names = known_columns(df, params.get("columns") or [], "drop_columns", params.get("onMissing", "error"))
    return df.drop(*names)


def select_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    names = known_columns(df, params.get("columns") or [], "select_columns", params.get("onMissing", "error"))
    if not names:
        raise SpecError("select_columns would keep no column")
    return df.select(*[column_of(df, name) for name in names])


def filter_rows(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    if not params.get("condition"):
        raise SpecError("filter needs 'condition'")
    return df.filter(params["condition"])


def _may_read(config: Mapping[str, Any], batch: Mapping[str, Any]) -> bool:
    """Whether a field redefines, or mentions anywhere in its parameters, a name of the batch."""
    pending = {name.lower() for name in batch}
    if config["name"].lower() in pending:
        return True
    texts = []
    for key in ("column", "columns", "start_date", "end_date", "condition", "expression"):
        value = config.get(key)
        texts.extend(value if isinstance(value, list) else [value])
    mentioned = " ".join(str(text) for text in texts if text is not None).lower()
    return any(re.search(rf"(?<!\w){re.escape(name)}(?!\w)", mentioned) for name in pending)


def _lookup_join(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """A large lookup as a left join with the mapping as a table."""
    column = column_of(df, config["column"])
    key_type = type_of(df, config["column"])
    keys, values, default, value_type = lookup_entries(config, key_type)
    if not keys:
        return df.withColumn(config["name"], F.lit(default).cast(value_type))
    stored_type = T.StringType() if isinstance(key_type, TEMPORAL) else key_type
    schema = T.StructType(
        [T.StructField("__key", stored_type), T.StructField("__found", value_type), T.StructField("__place", T.LongType())]
    )
    table = df.sparkSession.createDataFrame(list(zip(keys, values, range(len(keys)))), schema)
    table = table.select(F.col("__key").cast(key_type).alias("__key"), "__found", "__place").dropna(subset=["__key"])
    if isinstance(key_type, TEMPORAL) or any(key != key for key in keys):
        # Two spellings of one instant are one key, as are two of no number; the first counts. All other keys differ.
        table = table.groupBy("__key").agg(F.min_by("__found", "__place").alias("__found"))
    table = table.select("__key", "__found", F.lit(True).alias("__hit"))
    if len(keys) <= LOOKUP_BROADCAST_ENTRIES:
        table = F.broadcast(table)
    value = F.when(F.col("__hit"), F.col("__found")).otherwise(F.lit(default).cast(value_type))
    joined = df.join(table, column == F.col("__key"), "left")
    return joined.withColumn(config["name"], value).drop("__key", "__found", "__hit")
