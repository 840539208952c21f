"""Steps over groups and pairs of tables: dedupe, joins, unions, aggregates and pivots."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.columns import column_of, is_string, known_columns, type_of
from recordflow.operators.ranges import Range, pairs_in_range
from recordflow.plans.staging import estimated_bytes

log = logging.getLogger(__name__)

# A side is broadcast on request only while Spark's size estimate stays below this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more bytes of rows than this is hot: its rows should not meet in one task.
HOT_BYTES = 4 * 1024**3
# What a value without a fixed width is taken to have.
VALUE_BYTES = 64
# More pivot columns than this are refused, as Spark does, unless ``maxValues`` says otherwise.
MAX_PIVOT_VALUES = 10_000
JOIN_TYPES = ("inner", "left", "right", "full", "semi", "anti")
# What lets rows meet in a join without an equality.
RANGES = ("between", "overlaps")
AGGREGATES = ("sum", "avg", "count", "min", "max")


def order_columns(df: DataFrame, items: Sequence[Any], where: str) -> list[tuple[str, bool]]:
    """``orderBy`` items, a name or ``{"column": name, "desc": bool}``, as (name, descending)."""
    pairs = []
    for item in items:
        if isinstance(item, Mapping):
            pairs.append((item["column"], bool(item.get("desc", False))))
        else:
            pairs.append((item, False))
    known_columns(df, [name for name, _ in pairs], where)
    return pairs


def sort_keys(df: DataFrame, order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [column_of(df, name).desc() if desc else column_of(df, name).asc() for name, desc in order]


def deduplicate(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """One row per key: any row, or the first by ``orderBy``.

    Each key is reduced to one row per task before the shuffle, so a hot key stays small.
    """
    subset = known_columns(df, params.get("subset") or [], "deduplicate")
    order = order_columns(df, params.get("orderBy") or [], "deduplicate")
    if not order and (not subset or not _dedupe_needs_sort(df, subset)):
        return df.dropDuplicates(subset) if subset else df.dropDuplicates()
    keys = [column_of(df, name) for name in subset or df.columns]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*(sort_keys(df, order) or keys)))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def _dedupe_needs_sort(df: DataFrame, subset: Sequence[str]) -> bool:
    """Whether ``dropDuplicates`` would sort instead of hash.

    It does when a column outside the key has no fixed width. Taking row number 1 then costs about
    half, as its limit drops rows right after the sort.
    """
    inside = {name.lower() for name in subset}
    types = {field.name.lower(): field.dataType for field in df.schema}
    fixed_width = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return not all(isinstance(types[name], fixed_width) for name in types.keys() - inside)


def hot_rows(df: DataFrame, params: Mapping[str, Any]) -> int:
    """Rows from which a key is hot: ``hotRows``, else as many as make HOT_BYTES of this width."""
    if "hotRows" in params:
        return params["hotRows"]
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    width = sum(8 if isinstance(field.dataType, fixed) else VALUE_BYTES for field in df.schema)
    return HOT_BYTES // max(width, 1)


def join(
    left: DataFrame, right: DataFrame, params: Mapping[str, Any], look_for_skew: bool = False
) -> DataFrame:
    """Equality join on ``on``, with an optional further ``condition`` over the aliases l and r.

    ``on`` items are a shared name or ``{"left": name, "right": name}``. A shared key appears
    once; another right-hand column whose name the left side has gets the suffix ``_right``.

    Adaptive execution splits a hot key of either side of an inner join, but in an outer join
    only on the side that is kept. With ``look_for_skew`` the other side is checked for hot keys
    first (rows per key are counted, combined before the shuffle), and an outer join over one is
    put together from an inner and an anti join. Rows of a full join without a key match nothing
    and are set aside, since all of them would meet in one task.

    Without an equality a join needs a range to meet by: ``between`` is ``{"value", "low", "high"}``, the value being
    on the left unless ``side`` says ``right``, and ``overlaps`` is ``{"left": [low, high], "right": [low, high]}``; both take ``bounds``.
    A range can stand beside equalities, too.
    """
    how = params.get("how", "inner")
    if how not in JOIN_TYPES:
        raise SpecError(f"join type {how!r} is not one of {list(JOIN_TYPES)}")
    pairs = []
    for item in params.get("on") or []:
        pairs.append((item["left"], item["right"]) if isinstance(item, Mapping) else (item, item))
    ranged = any(params.get(name) for name in RANGES)
    if not pairs and not ranged:
        raise SpecError(f"join needs at least one equality in 'on', or one of {list(RANGES)}")
    known_columns(left, [name for name, _ in pairs], "join, left side")
    known_columns(right, [name for _, name in pairs], "join, right side")
    if ranged:
        return _range_join(left, right, pairs, how, params, measured=look_for_skew)

    sides = _Sides(left, right, pairs, params.get("condition"))
    if how in ("semi", "anti"):
        return left.alias("l").join(_maybe_broadcast(sides.right_keys(), params), sides.match(), f"left_{how}")
    if how == "full":
        keyed = _Sides(*sides.with_keys(), pairs, params.get("condition"))
        result = keyed.joined(how, params, look_for_skew)
        return result.unionByName(sides.without_key("left")).unionByName(sides.without_key("right"))
    return sides.joined(how, params, look_for_skew)


def _range_join(left, right, pairs, how: str, params: Mapping[str, Any], measured: bool) -> DataFrame:
    """Pairs that meet in bins, and the rows of an outer side that are in none of them.

    A row has a partner if one with the same values in the compared columns has, so these tell rows without a partner; with a
    ``condition`` all columns do. They are compared null-safely and reduced to one row per value before the shuffle.
    """
    found = Range(left, right, params)
    sides = _Sides(left, right, pairs, params.get("condition"))
    match = found.match(_qualified)
    if params.get("condition"):
        match = match & F.expr(params["condition"])
    met = pairs_in_range(left, right, found, pairs, match, measured)
    if how == "inner":
        return met.select(*sides.output("inner"))

    def alone(alias: str, kind: str = "left_anti") -> DataFrame:
        df, place = (left, 0) if alias == "l" else (right, 1)
        names = df.columns if params.get("condition") else list(dict.fromkeys([*[p[place] for p in pairs], *found.ends[place]]))
        matched = met.select(*[_qualified(alias, name).alias(f"m{i}") for i, name in enumerate(names)]).distinct()
        same = reduce(lambda a, b: a & b, [_qualified(alias, name).eqNullSafe(F.col(f"m{i}")) for i, name in enumerate(names)])
        return df.alias(alias).join(matched, same, kind)

    if how in ("semi", "anti"):
        return alone("l", f"left_{how}")
    result = met.select(*sides.output("inner"))
    if how in ("left", "full"):
        result = result.unionByName(alone("l").select(*sides.output("left", without="r")))
    if how in ("right", "full"):
        result = result.unionByName(alone("r").select(*sides.output("right", without="l")))
    return result


class _Sides:
    """The two sides of a join under the aliases l and r, and the shape of its result."""

    def __init__(self, left, right, pairs, condition):
        self.left, self.right, self.pairs, self.condition = left, right, pairs, condition
        self.shared = {a.lower() for a, b in pairs if a.lower() == b.lower()}

    def joined(self, how: str, params: Mapping[str, Any], look_for_skew: bool) -> DataFrame:
        if look_for_skew and self.has_hot_key(how, params):
            return self.outer_by_parts(how)
        right = _maybe_broadcast(self.right.alias("r"), params)
        return self.left.alias("l").join(right, self.match(), how).select(*self.output(how))

    def with_keys(self) -> tuple[DataFrame, DataFrame]:
        """Both sides without the rows that have NULL in a key."""
        left = self.left.filter(_all_known(self.left, [a for a, _ in self.pairs]))
        return left, self.right.filter(_all_known(self.right, [b for _, b in self.pairs]))

    def without_key(self, side: str) -> DataFrame:
        """The rows of one side that have NULL in a key, in the shape of the result."""
        df, alias, other = (self.left, "l", "r") if side == "left" else (self.right, "r", "l")
        names = [a if side == "left" else b for a, b in self.pairs]
        return df.filter(~_all_known(df, names)).alias(alias).select(*self.output(side, without=other))

    def match(self) -> Column:
        parts = [_qualified("l", a) == _qualified("r", b) for a, b in self.pairs]
        if self.condition:
            parts.append(F.expr(self.condition))
        return reduce(lambda a, b: a & b, parts)

    def left_keys(self) -> DataFrame:
        return self._keys_of(self.left, [a for a, _ in self.pairs]).alias("l")

    def right_keys(self) -> DataFrame:
        return self._keys_of(self.right, [b for _, b in self.pairs]).alias("r")

    def _keys_of(self, df: DataFrame, names: list[str]) -> DataFrame:
        """What a semi or anti join needs of a side: without a condition, one row per key."""
        return df if self.condition else df.select(*dict.fromkeys(names)).distinct()

    def has_hot_key(self, how: str, params: Mapping[str, Any]) -> bool:
        """Whether a side that Spark cannot split in this outer join has a hot key."""
        checked = []
        if how in ("left", "full"):
            checked.append((self.right, [b for _, b in self.pairs]))
        if how in ("right", "full"):
            checked.append((self.left, [a for a, _ in self.pairs]))
        for df, names in checked:
            counts = df.dropna(subset=names).groupBy(*[column_of(df, name) for name in names]).count()
            if counts.filter(F.col("count") > hot_rows(df, params)).head(1):
                return True
        return False

    def outer_by_parts(self, how: str) -> DataFrame:
        left, right = self.left.alias("l"), self.right.alias("r")
        result = left.join(right, self.match(), "inner").select(*self.output("inner"))
        if how in ("left", "full"):
            alone = left.join(self.right_keys(), self.match(), "left_anti")
            result = result.unionByName(alone.select(*self.output("left", without="r")))
        if how in ("right", "full"):
            alone = right.join(self.left_keys(), self.match(), "left_anti")
            result = result.unionByName(alone.select(*self.output("right", without="l")))
        return result

    def output(self, how: str, without: str | None = None) -> list[Column]:
        """The result columns; those of the side named by ``without`` are NULL."""
        right_names = {name.lower(): name for name in self.right.columns}
        left_names = {name.lower() for name in self.left.columns}
        output = []
        for field in self.left.schema:
            column = _qualified("l", field.name)
            if field.name.lower() in self.shared:
                other = _qualified("r", right_names[field.name.lower()])
                if how == "right":
                    column = other
                elif how == "full":
                    column = F.coalesce(column, other)
            elif without == "l":
                column = F.lit(None).cast(field.dataType)
            output.append(column.alias(field.name))
        for field in self.right.schema:
            if field.name.lower() not in self.shared:
                column = F.lit(None).cast(field.dataType) if without == "r" else _qualified("r", field.name)
                clash = field.name.lower() in left_names
                output.append(column.alias(f"{field.name}_right" if clash else field.name))
        return output


def union(frames: Sequence[DataFrame], params: Mapping[str, Any]) -> DataFrame:
    """Rows of all frames by column name, optionally distinct."""
    allow_missing = bool(params.get("allowMissing", False))
    first = {name.lower() for name in frames[0].columns}
    for frame in frames[1:]:
        if not allow_missing and {name.lower() for name in frame.columns} != first:
            raise SpecError(f"union of different columns {frames[0].columns} and {frame.columns}; set allowMissing")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
    return merged.distinct() if params.get("distinct") else merged


def aggregate(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    group_by, aggregations = params.get("groupBy") or [], params.get("aggregations") or []
    if not group_by or not aggregations:
        raise SpecError("aggregate needs 'groupBy' and 'aggregations'")
    known_columns(df, group_by, "aggregate")
    results = []
    for config in aggregations:
        function, name = config["function"], config["column"]
        results.append(_aggregate(df, function, name).alias(config.get("alias", f"{function}_{name}")))
    return df.groupBy(*[column_of(df, name) for name in group_by]).agg(*results)


def pivot(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """One column per pivot value; without ``values`` they are looked up first.

    The default cell is the first value by ``orderBy``. Without an order it is the first one met, which depends on row order unless a
    cell has one row. Each cell is reduced to its first row per task before the shuffle.
    """
    name, value = params.get("pivotColumn"), params.get("valueColumn")
    if not name or not value:
        raise SpecError("pivot needs 'pivotColumn' and 'valueColumn'")
    group_by = params.get("groupBy") or []
    known_columns(df, [*group_by, name, value], "pivot")
    function = params.get("aggregate", "first")
    values = params.get("values") or pivot_values(df, name, params.get("maxValues", MAX_PIVOT_VALUES))
    if params.get("orderBy"):
        if function != "first":
            raise SpecError("'orderBy' of a pivot is for the aggregate 'first'")
        df = deduplicate(df, {"subset": list(dict.fromkeys([*group_by, name])), "orderBy": params["orderBy"]})
    cell = F.first(column_of(df, value)) if function == "first" else _aggregate(df, function, value)
    return df.groupBy(*[column_of(df, key) for key in group_by]).pivot(name, values).agg(cell)


def pivot_values(df: DataFrame, name: str, limit: int = MAX_PIVOT_VALUES) -> list[Any]:
    """The distinct values of a pivot column in order; more than ``limit`` columns are refused."""
    known_columns(df, [name], "pivot")
    found = df.select(column_of(df, name).alias("value")).distinct().orderBy("value").limit(limit + 1).collect()
    if len(found) > limit:
        raise SpecError(f"pivot column {name!r} has more than {limit} values")
    return [row["value"] for row in found]


def _aggregate(df: DataFrame, function: str, name: str) -> Column:
    if function not in AGGREGATES:
        raise SpecError(f"aggregate function {function!r} is not one of {list(AGGREGATES)}")
    if name == "*":
        if function != "count":
            raise SpecError(f"{function} needs a column")
        return F.count(F.lit(1))
    known_columns(df, [name], "aggregate")
    column = column_of(df, name)
    if function in ("sum", "avg") and is_string(type_of(df, name)):
        column = column.try_cast("double")
    return getattr(F, function)(column)


def _all_known(df: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (column_of(df, name).isNotNull() for name in names))


def _qualified(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def _maybe_broadcast(right: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    if not params.get("broadcast"):
        return right
    size, limit = estimated_bytes(right), params.get("maxBroadcastBytes", MAX_BROADCAST_BYTES)
    if size > limit:
        log.warning("broadcast hint ignored: the side is estimated at %d bytes, the limit is %d", size, limit)
        return right
    return F.broadcast(right)
