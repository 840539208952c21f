"""Column lookup and literal conversion shared by rules, field functions and steps."""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterable
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
# Bit width of each integral type, to keep literals inside its range.
INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def column_of(df: DataFrame, name: str) -> Column:
    """The column called ``name``; a dot means a nested field unless a column has that very name."""
    if name in df.columns:
        return F.col("`" + name.replace("`", "``") + "`")
    return F.col(name)


def type_of(df: DataFrame, column: str | Column) -> T.DataType:
    """The type of a column by name, or of any expression over the frame."""
    if isinstance(column, str):
        # The schema is kept by the frame; an expression has to be analysed each time.
        if column in df.columns:
            return df.schema[column].dataType
        column = column_of(df, column)
    return df.select(column).schema[0].dataType


def known_columns(df: DataFrame, names: Iterable[str], where: str, on_missing: str = "error") -> list[str]:
    """The given names that exist in ``df``; a missing one is an error unless it may be skipped."""
    have = {name.lower() for name in df.columns}
    names = list(names)
    missing = [name for name in names if name.lower() not in have]
    if missing and on_missing != "skip":
        raise SpecError(f"{where}: no column {missing}; known: {df.columns}")
    return [name for name in names if name.lower() in have]


def is_string(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def as_text(df: DataFrame, name: str) -> Column:
    """A column as text; strings, binaries and arrays are left as they are."""
    column = column_of(df, name)
    data_type = type_of(df, name)
    if is_string(data_type) or isinstance(data_type, (T.BinaryType, T.ArrayType)):
        return column
    return column.cast("string")


def as_date(df: DataFrame, name: str) -> Column:
    """A column usable as a date; text that is no date becomes NULL."""
    column = column_of(df, name)
    return column.try_cast("date") if is_string(type_of(df, name)) else column


def value_for(value, data_type: T.DataType):
    """``value`` as a value of ``data_type``; None when no value of that type equals it.

    Dates and timestamps come back as ISO text, to be read in the session's time zone.
    """
    if is_string(data_type):
        return str(value).lower() if isinstance(value, bool) else str(value)
    if isinstance(data_type, T.BooleanType):
        if isinstance(value, str):
            return {"true": True, "false": False}.get(value.strip().lower())
        return value if isinstance(value, bool) else None
    if isinstance(data_type, TEMPORAL):
        return _iso_text(value, data_type)
    number = _number(value)
    if number is None:
        return None
    if isinstance(data_type, INTEGRAL):
        bound = 1 << (INTEGRAL_BITS[type(data_type)] - 1)
        if not number.is_finite() or number != number.to_integral_value() or not -bound <= number < bound:
            return None
        return int(number)
    if isinstance(data_type, FLOATING):
        return float(number)
    if isinstance(data_type, T.DecimalType):
        if not number.is_finite() or abs(number) >= Decimal(10) ** (data_type.precision - data_type.scale):
            return None
        return number if number == number.quantize(Decimal(1).scaleb(-data_type.scale)) else None
    return value


def literal_for(value, data_type: T.DataType) -> Column | None:
    """``value`` as a literal of ``data_type``; None when no value of that type equals it."""
    if value is None:
        return F.lit(None).cast(data_type)
    converted = value_for(value, data_type)
    return None if converted is None else F.lit(converted).cast(data_type)


def bound_literal(value, data_type: T.DataType, upper: bool) -> Column | None:
    """A range bound for a native comparison; None when the bound excludes nothing."""
    if isinstance(data_type, TEMPORAL):
        text = _iso_text(value, data_type)
        if text is None:
            raise SpecError(f"bound {value!r} is no {data_type.simpleString()}")
        return F.lit(text).cast(data_type)
    number = _number(value)
    if number is None:
        raise SpecError(f"bound {value!r} is not a number")
    if number.is_infinite() and (number > 0) == upper:
        return None
    if isinstance(data_type, INTEGRAL) and number.is_finite():
        # x > 7.5 is x > 7 and x < 7.5 is x < 8 for whole x: no cast of the field to double.
        whole = math.floor(number) if upper else math.ceil(number)
        if -(1 << 63) <= whole < 1 << 63:
            return F.lit(whole).cast("bigint")
        return F.lit(Decimal(whole))
    if isinstance(data_type, T.DecimalType) and number.is_finite():
        return F.lit(number)
    return F.lit(float(number))


def _number(value) -> Decimal | None:
    if isinstance(value, bool):
        return Decimal(int(value))
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        return None
    return None if number.is_nan() else number


def _iso_text(value, data_type: T.DataType) -> str | None:
    if isinstance(value, datetime.date):
        return value.isoformat()
    read = datetime.date if isinstance(data_type, T.DateType) else datetime.datetime
    try:
        return read.fromisoformat(str(value)).isoformat()
    except ValueError:
        return None
