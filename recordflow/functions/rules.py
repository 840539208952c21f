"""Validators: builders of a Column that holds an error message, or NULL when a row passes.

``when`` without ``otherwise`` is what makes a NULL condition pass: a NULL value fails only the
rules that ask for NULL, without the others having to exclude it. Conditions mention the field
as few times as possible, since a filter repeats the field's own expression each time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.columns import (
    bound_literal,
    column_of,
    is_string,
    literal_for,
    type_of,
)

Validator = Callable[[DataFrame, str, Mapping[str, Any]], Column]

# The pattern of an e-mail address and the default message of each rule.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
MESSAGES = {
    "notNull": "{field} cannot be null",
    "notEmpty": "{field} cannot be empty",
    "isNumeric": "{field} must be numeric",
    "rangeCheck": "{field} must be between {min} and {max}",
    "regex": "{field} does not match required pattern",
    "email": "{field} must be valid email",
    "length": "{field} length must be between {min} and {max}",
    "inList": "{field} must be one of {values}",
    "custom": "{field} failed custom validation",
}


def not_null(df, field, params):
    return _error(column_of(df, field).isNull(), params, _message("notNull", field))


def not_empty(df, field, params):
    text = F.coalesce(F.trim(column_of(df, field)), F.lit(""))
    return _error(text == "", params, _message("notEmpty", field))


def is_numeric(df, field, params):
    value = column_of(df, field)
    data_type = type_of(df, field)
    if isinstance(data_type, T.NumericType):
        return _no_error()
    if isinstance(data_type, T.DateType):
        condition = value.isNotNull()
    else:
        condition = value.try_cast("double").isNull() & value.isNotNull()
    return _error(condition, params, _message("isNumeric", field))


def range_check(df, field, params):
    low, high = params.get("min"), params.get("max")
    if low is None and high is None:
        raise SpecError(f"rangeCheck on {field!r} needs 'min' or 'max'")
    value = column_of(df, field)
    data_type = type_of(df, field)
    if is_string(data_type):
        value, data_type = value.try_cast("double"), T.DoubleType()
    lower = None if low is None else bound_literal(low, data_type, upper=False)
    upper = None if high is None else bound_literal(high, data_type, upper=True)
    shown_low = float("-inf") if low is None else low
    shown_high = float("inf") if high is None else high
    message = _message("rangeCheck", field, min=shown_low, max=shown_high)
    return _outside(value, lower, upper, params, message)


def regex(df, field, params):
    if "pattern" not in params:
        raise SpecError(f"regex on {field!r} needs 'pattern'")
    return _no_match(df, field, params["pattern"], params, _message("regex", field))


def email(df, field, params):
    return _no_match(df, field, EMAIL_PATTERN, params, _message("email", field))


def length(df, field, params):
    low, high = params.get("min"), params.get("max")
    if low is None and high is None:
        raise SpecError(f"length on {field!r} needs 'min' or 'max'")
    low = 0 if low is None else low
    shown_high = float("inf") if high is None else high
    size = F.length(column_of(df, field))
    lower = bound_literal(low, T.IntegerType(), upper=False)
    upper = None if high is None else bound_literal(high, T.IntegerType(), upper=True)
    return _outside(size, lower, upper, params, _message("length", field, min=low, max=shown_high))


def in_list(df, field, params):
    if "values" not in params:
        raise SpecError(f"inList on {field!r} needs 'values'")
    values = params["values"]
    value = column_of(df, field)
    data_type = type_of(df, field)
    literals = [literal_for(item, data_type) for item in values]
    literals = [literal for literal in literals if literal is not None]
    condition = ~value.isin(literals) if literals else value.isNotNull()
    return _error(condition, params, _message("inList", field, values=values))


def custom(df, field, params):
    if "expression" not in params:
        raise SpecError(f"custom on {field!r} needs 'expression'")
    condition = F.expr(params["expression"].replace("{field}", field))
    return _error(~condition, params, _message("custom", field))


class RuleRegistry:
    """Validators by name; users add their own with ``register``."""

    def __init__(self):
        self._validators: dict[str, Validator] = {
            "notNull": not_null,
            "notEmpty": not_empty,
            "isNumeric": is_numeric,
            "rangeCheck": range_check,
            "regex": regex,
            "email": email,
            "length": length,
            "inList": in_list,
            "custom": custom,
        }

    def register(self, name: str, validator: Validator) -> None:
        self._validators[name] = validator

    def get(self, name: str) -> Validator:
        if name not in self._validators:
            raise SpecError(f"unknown validator {name!r}; known: {self.names()}")
        return self._validators[name]

    def names(self) -> list[str]:
        return list(self._validators)


def _message(rule: str, field: str, **values) -> str:
    return MESSAGES[rule].format(field=field, **values)


def _error(condition: Column, params: Mapping[str, Any], default: str) -> Column:
    return F.when(condition, F.lit(params.get("error_message", default)))


def _no_error() -> Column:
    return F.lit(None).cast("string")


def _outside(value, lower, upper, params, default):
    if lower is None and upper is None:
        return _no_error()
    if lower is None:
        return _error(value > upper, params, default)
    if upper is None:
        return _error(value < lower, params, default)
    return _error((value < lower) | (value > upper), params, default)


def _no_match(df, field, pattern, params, default):
    value = column_of(df, field)
    if not is_string(type_of(df, field)):
        value = value.cast("string")
    return _error(~value.rlike(pattern), params, default)
