"""Ranking and offset windows that also hold when one partition key has most of the rows.

Spark sorts each window partition in one task. In a run, the keys with too many rows for that are
found first, whatever the size of the table (a count per key, combined before the shuffle).
Their rows are spread over sorted ranges, numbered inside each range, and shifted by the number
of rows in earlier ranges. All other keys go through the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.errors import SpecError
from recordflow.functions.columns import column_of, known_columns
from recordflow.operators.relational import hot_rows, order_columns, sort_keys
from recordflow.plans.staging import StagingArea

WINDOW_FUNCTIONS = ("row_number", "rank", "dense_rank", "lag", "lead")

RANGE, TIE, SHIFT, NUMBER, ROWS, CHUNK, OWN = (
    "__range", "__tie", "__shift", "__number", "__rows", "__chunk", "__own",
)


def window(df: DataFrame, params: Mapping[str, Any], area: StagingArea | None = None, planned: bool = False) -> DataFrame:
    """Add one window column: row_number, rank, dense_rank, lag or lead.

    Hot keys are looked for, and their rows staged: in the given area, or in one of its own below the session's folder.
    A window that is only ``planned`` starts no job and stands for its columns alone.
    """
    function, alias = params.get("function"), params.get("alias")
    if function not in WINDOW_FUNCTIONS:
        raise SpecError(f"window function {function!r} is not one of {list(WINDOW_FUNCTIONS)}")
    if not alias:
        raise SpecError("window needs 'alias'")
    if not params.get("orderBy"):
        raise SpecError(f"window function {function} needs 'orderBy'")
    if function in ("lag", "lead") and not params.get("column"):
        raise SpecError(f"{function} needs 'column'")
    keys = known_columns(df, params.get("partitionBy") or [], "window")
    if not keys and not params.get("allowGlobal"):
        raise SpecError("window without 'partitionBy' ranks the whole table; set allowGlobal to ask for it")
    if function in ("lag", "lead"):
        known_columns(df, [params["column"]], "window")
    order = order_columns(df, params["orderBy"], "window")

    if planned:
        return _plain(df, keys, order, params)
    area = area or StagingArea(df.sparkSession)
    limit = hot_rows(df, params)
    hot, hot_total = _hot_keys(df, keys, limit, area)
    if hot_total == 0:
        return _plain(df, keys, order, params)
    ranges = math.ceil(hot_total / max(limit, 1)) + 1
    if hot is None:
        return _spread(df, keys, order, params, ranges, limit, area)
    # A staged table: Spark broadcasts it if it is small, and else splits a hot key.
    match = _same_keys("t", "h", keys)
    table = df.alias("t")
    cold_rows = table.join(hot.alias("h"), match, "left_anti")
    hot_part = table.join(hot.alias("h"), match, "left_semi")
    return _plain(cold_rows, keys, order, params).unionByName(
        _spread(hot_part, keys, order, params, ranges, limit, area)
    )


def _plain(df, keys, order, params) -> DataFrame:
    spec = Window.partitionBy(*[column_of(df, key) for key in keys]).orderBy(*sort_keys(df, order))
    answer = _function(df, params).over(spec)
    return df.withColumn(params["alias"], answer if params["function"] in ("lag", "lead") else answer.cast("bigint"))


def _function(df: DataFrame, params: Mapping[str, Any]) -> Column:
    function = params["function"]
    if function in ("lag", "lead"):
        return getattr(F, function)(column_of(df, params["column"]), int(params.get("offset", 1)))
    return getattr(F, function)()


def _hot_keys(df: DataFrame, keys: Sequence[str], limit: int, area: StagingArea) -> tuple[DataFrame | None, int]:
    """The keys with more than ``limit`` rows, as a staged table, and their total row count.

    The count alone is asked for first: mostly there is no such key, and nothing to write.
    """
    if not keys:
        total = df.count()
        return None, total if total > limit else 0
    counts = df.groupBy(*[column_of(df, key) for key in keys]).agg(F.count(F.lit(1)).alias(ROWS))
    hot = counts.filter(F.col(ROWS) > limit)
    total = hot.agg(F.sum(ROWS)).first()[0]
    return (area.stage(hot.drop(ROWS), "window_hot_keys"), total) if total else (None, 0)


def _spread(df, keys, order, params, ranges, limit, area) -> DataFrame:
    if params["function"] in ("rank", "dense_rank"):
        return _spread_rank(df, keys, order, params, ranges, area)
    numbered = _spread_number(df, keys, order, ranges, area)
    if params["function"] == "row_number":
        return numbered.withColumn(params["alias"], F.col(NUMBER)).drop(NUMBER)
    return _spread_offset(numbered, keys, params, max(limit, abs(int(params.get("offset", 1)))))


def _spread_number(df, keys, order, ranges, area) -> DataFrame:
    """Number the rows of each key from 1 in the given order.

    The rows are staged with a unique tie-breaker first, so that equal rows can be in different
    ranges and a lost task cannot move a row from one range to another.
    """
    fixed = area.stage(df.withColumn(TIE, F.monotonically_increasing_id()), "window_rows")
    sorting = [*sort_keys(fixed, order), F.col(TIE)]
    placed = fixed.repartitionByRange(ranges, *[column_of(fixed, key) for key in keys], *sorting)
    placed = area.stage(placed.withColumn(RANGE, F.spark_partition_id()), "window_ranges")
    counts = placed.groupBy(*[column_of(placed, key) for key in keys], RANGE).agg(F.count(F.lit(1)).alias(ROWS))
    local = Window.partitionBy(*[column_of(placed, key) for key in keys], RANGE).orderBy(*sorting)
    local_number = F.row_number().over(local).cast("bigint")
    shifted = _add_shift(placed.withColumn(NUMBER, local_number), counts, keys)
    return shifted.withColumn(NUMBER, F.col(NUMBER) + F.col(SHIFT)).drop(SHIFT, RANGE, TIE)


def _spread_rank(df, keys, order, params, ranges, area) -> DataFrame:
    """Rank distinct order values, which are counted before any shuffle, and join the rank back."""
    names = list(dict.fromkeys([*keys, *[name for name, _ in order]]))
    values = df.groupBy(*[column_of(df, name) for name in names]).agg(F.count(F.lit(1)).alias(ROWS))
    key_columns = [column_of(values, key) for key in keys]
    sorting = sort_keys(values, order)
    placed = values.repartitionByRange(ranges, *key_columns, *sorting).withColumn(RANGE, F.spark_partition_id())
    placed = area.stage(placed, "window_values")
    local = Window.partitionBy(*key_columns, RANGE).orderBy(*sorting)
    if params["function"] == "rank":
        before = F.sum(ROWS).over(local.rowsBetween(Window.unboundedPreceding, -1))
        weight = F.sum(ROWS)
    else:
        before = F.row_number().over(local) - 1
        weight = F.count(F.lit(1))
    counts = placed.groupBy(*key_columns, RANGE).agg(weight.alias(ROWS))
    numbered = placed.withColumn(NUMBER, F.coalesce(before, F.lit(0)))
    ranked = _add_shift(numbered, counts, keys)
    ranked = ranked.select(*names, (F.col(NUMBER) + F.col(SHIFT) + 1).alias(params["alias"]))
    left = df.drop(params["alias"]) if params["alias"] not in names else df
    columns = [F.col(f"t.`{name}`") for name in left.columns]
    joined = left.alias("t").join(ranked.alias("h"), _same_keys("t", "h", names))
    return joined.select(*columns, F.col(f"h.`{params['alias']}`"))


def _spread_offset(numbered, keys, params, chunk_rows) -> DataFrame:
    """lag and lead over numbered rows, cut into chunks of consecutive numbers.

    A row whose value is needed in a neighbouring chunk is sent there as well, so each chunk is
    complete on its own.
    """
    offset = int(params.get("offset", 1)) * (1 if params["function"] == "lag" else -1)
    home = F.floor((F.col(NUMBER) - 1) / F.lit(chunk_rows))
    target = F.floor((F.col(NUMBER) - 1 + offset) / F.lit(chunk_rows))
    copies = F.when(home == target, F.array(home)).otherwise(F.array(home, target))
    sent = numbered.withColumn(CHUNK, F.explode(copies)).withColumn(OWN, F.col(CHUNK) == home)
    spec = Window.partitionBy(*[column_of(numbered, key) for key in keys], CHUNK).orderBy(NUMBER)
    answered = sent.withColumn(params["alias"], _function(numbered, params).over(spec))
    return answered.filter(OWN).drop(NUMBER, CHUNK, OWN)


def _add_shift(df, counts, keys) -> DataFrame:
    """Join each (key, range) with the number of rows in the earlier ranges of the key.

    ``counts`` has one row per key and range: about as many rows as there are hot keys and ranges.
    """
    earlier = Window.partitionBy(*[column_of(counts, key) for key in keys]).orderBy(RANGE)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *[column_of(counts, key) for key in keys],
        RANGE,
        F.coalesce(F.sum(ROWS).over(earlier), F.lit(0)).alias(SHIFT),
    )
    names = [*keys, RANGE]
    joined = df.alias("t").join(shifts.alias("h"), _same_keys("t", "h", names))
    return joined.select("t.*", f"h.{SHIFT}")


def _same_keys(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality that takes two NULLs as equal, as window partitions do."""
    pairs = (F.col(f"{left}.`{name}`").eqNullSafe(F.col(f"{right}.`{name}`")) for name in names)
    return reduce(lambda a, b: a & b, pairs)
