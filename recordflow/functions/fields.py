"""Field functions: builders of one computed Column from its parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.columns import (
    INTEGRAL,
    as_date,
    as_text,
    column_of,
    is_string,
    type_of,
    value_for,
)

FieldFunction = Callable[[DataFrame, Mapping[str, Any]], Column]

# The key under which a run passes its timestamp, so that all sinks of a run agree on it.
RUN_TIME = "__run_time"
HASH_SEPARATOR = "||"
# Above this many entries a lookup is planned as a join with a mapping table; values and types are the same.
LOOKUP_JOIN_ENTRIES = 1000
END_OF_STRING = 2**31 - 1


def current_timestamp(df, params):
    return F.lit(params[RUN_TIME]) if RUN_TIME in params else F.current_timestamp()


def current_date(df, params):
    return F.to_date(F.lit(params[RUN_TIME])) if RUN_TIME in params else F.current_date()


def literal(df, params):
    return F.lit(_need(params, "literal", "value"))


def uuid(df, params):
    return F.expr("uuid()")


def hash_columns(df, params):
    """Digest of the joined values; NULLs are left out unless ``nullToken`` stands in for them."""
    parts = [as_text(df, name) for name in _need(params, "hash", "columns")]
    if "nullToken" in params:
        parts = [F.coalesce(part, F.lit(params["nullToken"])) for part in parts]
    joined = F.concat_ws(HASH_SEPARATOR, *parts)
    algorithm = params.get("algorithm", "sha256")
    digests = {
        "md5": lambda: F.md5(joined),
        "sha1": lambda: F.sha1(joined),
        "sha256": lambda: F.sha2(joined, 256),
        "sha512": lambda: F.sha2(joined, 512),
    }
    if algorithm not in digests:
        raise SpecError(f"unknown hash algorithm {algorithm!r}; known: {list(digests)}")
    return digests[algorithm]()


def concat(df, params):
    """NULL if any part is NULL; with a separator NULL parts are left out instead."""
    parts = [as_text(df, name) for name in _need(params, "concat", "columns")]
    separator = params.get("separator")
    return F.concat_ws(separator, *parts) if separator else F.concat(*parts)


def substring(df, params):
    text = as_text(df, _need(params, "substring", "column"))
    return F.substring(text, params.get("start", 1), params.get("length") or END_OF_STRING)


def upper(df, params):
    return F.upper(as_text(df, _need(params, "upper", "column")))


def lower(df, params):
    return F.lower(as_text(df, _need(params, "lower", "column")))


def trim(df, params):
    return F.trim(as_text(df, _need(params, "trim", "column")))


def cast(df, params):
    """A value that does not convert becomes NULL; decimal text is cut to a whole number."""
    column = column_of(df, _need(params, "cast", "column"))
    target = _need(params, "cast", "type")
    converted = column.try_cast(target)
    if is_string(type_of(df, params["column"])) and isinstance(type_of(df, converted), INTEGRAL):
        whole_part = F.regexp_extract(F.trim(column), r"^([+-]?[0-9]+)\.[0-9]*$", 1)
        return F.coalesce(converted, whole_part.try_cast(target))
    return converted


def coalesce(df, params):
    names = _need(params, "coalesce", "columns")
    columns = [column_of(df, name) for name in names]
    if len({is_string(type_of(df, name)) for name in names}) == 2:
        columns = [as_text(df, name) for name in names]
    return F.coalesce(*columns)


def when(df, params):
    """``then`` where the condition holds, else ``otherwise``; of a text and another kind both are text."""
    condition, then = _need(params, "when", "condition"), _need(params, "when", "then")
    then, otherwise = _same_kind([then, params.get("otherwise")])
    chosen = F.when(F.expr(condition), F.lit(then))
    return chosen if otherwise is None else chosen.otherwise(F.lit(otherwise))


def year(df, params):
    return F.year(as_date(df, _need(params, "year", "column")))


def month(df, params):
    return F.month(as_date(df, _need(params, "month", "column")))


def day(df, params):
    return F.dayofmonth(as_date(df, _need(params, "day", "column")))


def datediff(df, params):
    start = as_date(df, _need(params, "datediff", "start_date"))
    end = as_date(df, _need(params, "datediff", "end_date"))
    return F.datediff(end, start)


def expression(df, params):
    return F.expr(_need(params, "expr", "expression"))


def lookup(df, params):
    """The value mapped to a column's value, else ``default``."""
    column = column_of(df, _need(params, "lookup", "column"))
    data_type = type_of(df, params["column"])
    keys, values, default, value_type = lookup_entries(params, data_type)
    otherwise = F.lit(default).cast(value_type)
    if not keys:
        return otherwise
    # The first of equal keys is found, however differently they are written.
    place = F.array_position(F.array(*[F.lit(key).cast(data_type) for key in keys]), column)
    found = F.get(F.array(*[F.lit(value).cast(value_type) for value in values]), place.cast("int") - 1)
    return F.when(place > 0, found).otherwise(otherwise)


def lookup_entries(
    params: Mapping[str, Any], key_type: T.DataType
) -> tuple[list[Any], list[Any], Any, T.DataType]:
    """Keys as values of the column's type, mapped values and default of one kind, and the type of these.

    A key that is no value of the column's type never matches; of two equal keys the first counts.
    """
    entries: dict[Any, Any] = {}
    for key, value in _need(params, "lookup", "mapping").items():
        converted = value_for(key, key_type)
        if converted is not None:
            entries.setdefault(converted, value)
    # All values decide on the kind, also those of keys that never match.
    kinds = _same_kind([*params["mapping"].values(), params.get("default")])
    value_type = _common_type(kinds)
    *values, default = [
        value if value is None else _as_kind(value, value_type) for value in [*entries.values(), params.get("default")]
    ]
    return list(entries), values, default, value_type


def _common_type(values: list[Any]) -> T.DataType:
    """The narrowest type for values of one kind; text if there are none."""
    known = [value for value in values if value is not None]
    if not known or any(isinstance(value, str) for value in known):
        return T.StringType()
    if all(isinstance(value, bool) for value in known):
        return T.BooleanType()
    if any(isinstance(value, float) for value in known):
        return T.DoubleType()
    fits = all(-(2**31) <= value < 2**31 for value in known)
    return T.IntegerType() if fits else T.LongType()


def _as_kind(value: Any, kind: T.DataType) -> Any:
    if isinstance(kind, T.StringType):
        return _same_kind(["", value])[1]
    if isinstance(kind, T.BooleanType):
        return value
    return float(value) if isinstance(kind, T.DoubleType) else int(value)


def _same_kind(values: list[Any]) -> list[Any]:
    """Numbers and flags as text when the list holds text as well."""
    if not any(isinstance(value, str) for value in values):
        return values
    return [
        value if value is None or isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)
        for value in values
    ]


class FieldRegistry:
    """Field functions by name; users add their own with ``register``."""

    def __init__(self):
        self._functions: dict[str, FieldFunction] = {
            "current_timestamp": current_timestamp,
            "current_date": current_date,
            "literal": literal,
            "uuid": uuid,
            "hash": hash_columns,
            "concat": concat,
            "substring": substring,
            "upper": upper,
            "lower": lower,
            "trim": trim,
            "cast": cast,
            "coalesce": coalesce,
            "when": when,
            "year": year,
            "month": month,
            "day": day,
            "datediff": datediff,
            "expr": expression,
            "lookup": lookup,
        }
        self._built_in = set(self._functions)

    def register(self, name: str, function: FieldFunction) -> None:
        self._functions[name] = function
        self._built_in.discard(name)

    def get(self, name: str) -> FieldFunction:
        if name not in self._functions:
            raise SpecError(f"unknown field function {name!r}; known: {self.names()}")
        return self._functions[name]

    def is_built_in(self, name: str) -> bool:
        return name in self._built_in

    def names(self) -> list[str]:
        return list(self._functions)


def _need(params: Mapping[str, Any], function: str, key: str):
    value = params.get(key)
    if value is None or value == "" or value == [] or value == {}:
        if not (key in ("value", "then") and value is not None):
            raise SpecError(f"{function} needs '{key}'")
    return value
