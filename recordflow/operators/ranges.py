"""Joins on ranges: a value within an interval, or two intervals that overlap, without comparing all pairs.

Compared values become whole numbers in the same order. An interval has a level by its length, so that it spans two bins of its
level's width at most, and rows meet in bins: each goes to those of its own level, and to those of wider levels that the other side has.
Whatever their lengths, a row is copied at most twice per level, and adaptive execution divides bins with very many rows.
Where few rows would meet in the widest bins alone, as within the days of a user, all rows go to these, and none is copied for other levels.
"""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.columns import FLOATING, INTEGRAL, column_of, known_columns, type_of
from recordflow.plans.staging import is_repeatable

BOUNDS = ("[]", "[)", "(]", "()")

#: Widths of bins are powers of 4, up to one bin for all values below 0 and one for the others.
LEVELS = (*range(0, 63, 2), 63)

#: Pairs to compare for each row, and within one bin, up to which all rows may go to the widest bins: less work than their copies.
PAIRS_PER_ROW = 32
PAIRS_PER_BIN = 10**8


class Range:
    """What a step's ``between`` or ``overlaps`` says: the columns of both sides, and the comparison."""

    def __init__(self, left: DataFrame, right: DataFrame, params: Mapping[str, Any]):
        if bool(params.get("between")) == bool(params.get("overlaps")):
            raise SpecError("a range join has either 'between' or 'overlaps'")
        found = params.get("between") or params["overlaps"]
        side = None
        if params.get("between"):
            side = found.get("side", "left")
            value, ends = [found["value"]] * 2, [found["low"], found["high"]]
            if side not in ("left", "right"):
                raise SpecError(f"'side' of the value of a range join is left or right, not {side!r}")
            self.ends = (value, ends) if side == "left" else (ends, value)
        else:
            self.ends = (list(found["left"]), list(found["right"]))
            if any(len(e) != 2 for e in self.ends):
                raise SpecError("'overlaps' of a range join has two columns on each side")
        self.bounds = found.get("bounds", "[]")
        if self.bounds not in BOUNDS:
            raise SpecError(f"'bounds' of a range join is one of {list(BOUNDS)}")
        if params.get("overlaps") and self.bounds not in ("[]", "()"):
            raise SpecError("'bounds' of overlapping intervals are [] or ()")
        kinds = set()
        for df, names, where in ((left, self.ends[0], "left"), (right, self.ends[1], "right")):
            known_columns(df, names, f"range join, {where} side")
            kinds |= {_kind(type_of(df, name), name) for name in names}
        if len(kinds) > 1:
            raise SpecError(f"a range join can't compare {' with '.join(sorted(kinds))}")
        self.value_on_left = side == "left"

    def match(self, qualified) -> Column:
        """The exact comparison, over the columns as they are."""
        (l_low, l_high), (r_low, r_high) = ([qualified(a, n) for n in names] for a, names in zip("lr", self.ends, strict=True))
        if self.bounds in ("[]", "()"):
            below = (lambda a, b: a <= b) if self.bounds == "[]" else (lambda a, b: a < b)
            return below(l_low, r_high) & below(r_low, l_high)
        value, low, high = (l_low, r_low, r_high) if self.value_on_left else (r_low, l_low, l_high)
        return (low <= value) & (value < high) if self.bounds == "[)" else (low < value) & (value <= high)


def _kind(data_type: T.DataType, name: str) -> str:
    for kind, types in (("number", (*INTEGRAL, *FLOATING, T.DecimalType)), ("date", (T.DateType,)), ("timestamp", (T.TimestampType,)), ("timestamp_ntz", (T.TimestampNTZType,))):
        if isinstance(data_type, types):
            return kind
    raise SpecError(f"a range join compares numbers, dates or timestamps, and {name!r} is {data_type.simpleString()}")


def _place(df: DataFrame, name: str, whole: bool) -> Column:
    """A whole number that grows with the column; all numbers are taken as fractions unless both sides are whole."""
    column, data_type = column_of(df, name), type_of(df, name)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)
    if whole:
        return column.cast("long")
    # Any growing function does, as pairs are compared exactly in the end: this one tells small from large numbers alike.
    number = column.cast("double")
    size = F.floor(F.log2(1 + F.abs(number) * float(1 << 20)) * float(1 << 20))
    return F.when(F.isnan(number), F.lit(1 << 40)).otherwise(F.signum(number).cast("long") * F.least(size, F.lit(1 << 32)))


class _Side:
    """One side with the level of its interval and the ends as whole numbers; rows without an interval are left out."""

    def __init__(self, df: DataFrame, alias: str, ends: list[str], whole: bool):
        low, high = (_place(df, name, whole) for name in ends)
        length = F.try_subtract(high, low)  # none beyond what a long can hold
        bits = F.when(length.isNull(), 63).when(length == 0, 0).otherwise(F.length(F.bin(length)))
        level = F.when(bits > 62, 63).otherwise(F.ceil(bits / 2) * 2).cast("int")  # a power of 4 above the length
        row = F.struct(*[column_of(df, c).alias(c) for c in df.columns]).alias(alias)
        self.alias, self.is_value, self.is_repeatable = alias, ends[0] == ends[1], is_repeatable(df)
        self.rows = df.where(low <= high).select(row, low.alias(f"{alias}_low"), high.alias(f"{alias}_high"), level.alias(f"{alias}_level"))

    def levels(self) -> list[int]:
        """The levels that occur, of ``LEVELS`` at most."""
        return sorted(_rows_by_level(self)[self.alias])

    def possible_levels(self) -> list[int] | Column:
        """The levels that rows can have, without a job: those that occur are found by the query itself, if rows come out the same there."""
        if self.is_value:
            return [0]
        if not self.is_repeatable:
            return list(LEVELS)
        return self.rows.agg(F.collect_set(f"{self.alias}_level")).scalar()

    def raised(self, level: int) -> _Side:
        """The same rows, all at one level that is as wide as any of theirs."""
        other = copy(self)
        other.rows = self.rows.withColumn(f"{self.alias}_level", F.lit(level))
        return other

    def in_bins(self, others: list[int] | Column) -> DataFrame:
        """A row for each bin: of the own level, and of each wider level of the other side."""
        a = self.alias
        own = F.col(f"{a}_level")
        others = others if isinstance(others, Column) else F.array(*[F.lit(x) for x in others]).cast("array<int>")
        # A column of its own, as there are no subqueries within functions of arrays.
        levels = F.concat(F.array(own), F.filter(f"{a}_others", lambda x: x > own))
        bins = F.transform(
            levels,
            lambda x: F.transform(
                F.array_distinct(F.array(_shifted(F.col(f"{a}_low"), x), _shifted(F.col(f"{a}_high"), x))),
                lambda b: F.struct(x.alias("level"), b.alias("bin")),
            ),
        )
        return self.rows.withColumn(f"{a}_others", others).withColumn(f"{a}_at", F.explode(F.flatten(bins))).drop(f"{a}_others")


def _shifted(column: Column, level: Column) -> Column:
    """The bin of a number: its quotient by the level's width, rounded down."""
    return F.call_function("shiftright", column, level)


def _rows_by_level(*sides: _Side) -> dict[str, dict[int, int]]:
    """For each side the number of rows by level; one job, so that what both sides read is read once."""
    levels = reduce(DataFrame.union, [side.rows.select(F.lit(side.alias).alias("side"), F.col(f"{side.alias}_level").alias("level")) for side in sides])
    found: dict[str, dict[int, int]] = {side.alias: {} for side in sides}
    for row in levels.groupBy("side", "level").count().collect():
        found[row["side"]][row["level"]] = row["count"]
    return found


def _few_meet(a: _Side, b: _Side, pairs: list[tuple[str, str]], level: int, n_rows: int) -> bool:
    """Whether few pairs would meet if all rows were in bins of this level. Rows are counted by bin and key, added up before the shuffle."""
    counts = []
    for side, names in ((a, [x for x, _ in pairs]), (b, [y for _, y in pairs])):
        keys = [F.col(f"{side.alias}.`{name}`").alias(f"{side.alias}_{i}") for i, name in enumerate(names)]
        binned = side.raised(level).in_bins([]).select(F.col(f"{side.alias}_at.bin").alias(f"{side.alias}_bin"), *keys)
        counts.append(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).cast("double").alias(f"{side.alias}_n")))
    same = reduce(lambda x, y: x & y, [F.col(f"l_{k}") == F.col(f"r_{k}") for k in ("bin", *range(len(pairs)))])
    meeting = F.col("l_n") * F.col("r_n")
    found = counts[0].join(counts[1], same).agg(F.sum(meeting).alias("pairs"), F.max(meeting).alias("hottest")).first()
    return (found["pairs"] or 0) <= PAIRS_PER_ROW * n_rows and (found["hottest"] or 0) <= PAIRS_PER_BIN


def pairs_in_range(left: DataFrame, right: DataFrame, found: Range, pairs: list[tuple[str, str]], match: Column, measured: bool = True) -> DataFrame:
    """The structs ``l`` and ``r`` of all rows that match, by bins and the equalities ``pairs``.

    With ``measured``, the levels that occur are looked up first, and whether the widest do alone; else no job is started, and the levels
    are found by a subquery. Of rows that differ when they are computed again, all levels that there could be are taken.
    """
    whole = all(not isinstance(type_of(df, n), (*FLOATING, T.DecimalType)) for df, names in zip((left, right), found.ends, strict=True) for n in names)
    a, b = (_Side(df, alias, ends, whole) for df, alias, ends in zip((left, right), "lr", found.ends, strict=True))
    if measured and a.is_repeatable and b.is_repeatable:  # other rows might come with other levels than those looked up
        rows = _rows_by_level(a, b)
        of_a, of_b = sorted(rows["l"]), sorted(rows["r"])
        widest = max([*of_a, *of_b], default=0)
        if len({*of_a, *of_b}) > 1 and _few_meet(a, b, pairs, widest, sum(rows["l"].values()) + sum(rows["r"].values())):
            a, b, of_a, of_b = a.raised(widest), b.raised(widest), [], []
    else:
        of_a, of_b = a.possible_levels(), b.possible_levels()
    at = F.col("l_at")
    same = [at == F.col("r_at"), *[F.col(f"l.`{x}`") == F.col(f"r.`{y}`") for x, y in pairs]]
    # Of the bins that two rows share, they are compared in the one where the later begins, at the wider of their levels.
    wider = F.greatest("l_level", "r_level")
    once = (at["level"] == wider) & (at["bin"] == _shifted(F.greatest("l_low", "r_low"), wider))
    both = reduce(lambda x, y: x & y, [*same, once, match])
    return a.in_bins(of_b).join(b.in_bins(of_a), both).select("l", "r")

