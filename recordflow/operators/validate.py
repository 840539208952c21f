"""Rule sets: per-field error maps and the split into valid and rejected rows."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.errors import SpecError
from recordflow.functions.rules import RuleRegistry

log = logging.getLogger(__name__)

ERRORS = "validation_errors"
DETAILS = "validation_details"
# Tells valid rows from others in a marked frame.
VALID_FLAG = "__valid"
CORRUPT_CONF = "spark.sql.columnNameOfCorruptRecord"

ERRORS_TYPE = "map<string,string>"
DETAILS_TYPE = "array<struct<field:string,rule:string,message:string>>"


@dataclass(frozen=True)
class BoundRule:
    field: str
    rule: str
    message: Column


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame


def bind_rules(
    df: DataFrame, entries: Sequence[Mapping[str, Any]], registry: RuleRegistry
) -> list[BoundRule]:
    """Turn the rule entries of a spec into message columns, in declared order.

    The field entry is merged over a rule's own parameters, so a message given for the field
    wins over one given for the rule. The entries are left unchanged.
    """
    bound = []
    for entry in entries:
        if "field" not in entry:
            raise SpecError(f"validation entry without 'field': {entry}")
        for rule in entry.get("validations") or []:
            if isinstance(rule, str):
                name, params = rule, dict(entry)
            elif isinstance(rule, Mapping):
                name, params = rule.get("type"), {**(rule.get("params") or {}), **entry}
            else:
                log.warning("skipping a rule of field %s that is no name and no object: %r", entry["field"], rule)
                continue
            bound.append(BoundRule(entry["field"], name, registry.get(name)(df, entry["field"], params)))
    if bound:
        bound = _corrupt_record_rule(df) + bound
    return bound


def mark(
    df: DataFrame, entries: Sequence[Mapping[str, Any]], registry: RuleRegistry | None = None
) -> DataFrame:
    """Add the flag of valid rows: those for which no rule gives a message."""
    bound = bind_rules(df, entries, registry or RuleRegistry())
    # One IS NULL per rule: Catalyst folds each into a plain predicate and can push it to the scan.
    passed = reduce(lambda left, right: left & right, (rule.message.isNull() for rule in bound), F.lit(True))
    return df.withColumn(VALID_FLAG, passed)


def with_errors(
    df: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    registry: RuleRegistry | None = None,
    details: bool = False,
) -> DataFrame:
    """Add the map of first messages per field and, on request, the list of every failing rule."""
    bound = bind_rules(df, entries, registry or RuleRegistry())
    by_field: dict[str, list[Column]] = {}
    for rule in bound:
        by_field.setdefault(rule.field, []).append(rule.message)
    first = {f"__first_{position}": F.coalesce(*messages) for position, messages in enumerate(by_field.values())}
    # The first message of each field is a column before it goes into the map, so that it is
    # computed once; Catalyst keeps the two projections apart, but in one stage.
    added = {**first, DETAILS: _details(bound)} if details else first
    errors = _error_map({field: F.col(name) for field, name in zip(by_field, first)})
    return (df.withColumns(added) if added else df).withColumn(ERRORS, errors).drop(*first)


def annotate(
    df: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    registry: RuleRegistry | None = None,
    details: bool = False,
) -> DataFrame:
    """All rows with both the flag and the errors."""
    return mark(with_errors(df, entries, registry, details), entries, registry)


def judged(
    df: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    registry: RuleRegistry | None = None,
    details: bool = False,
) -> DataFrame:
    """All rows with the errors, and the flag read off them: for rules that must be asked only once."""
    annotated = with_errors(df, entries, registry, details)
    return annotated.withColumn(VALID_FLAG, F.size(ERRORS) == 0)


def accepted(marked: DataFrame) -> DataFrame:
    """The valid rows of a marked frame, with the original columns."""
    return marked.filter(F.col(VALID_FLAG)).drop(VALID_FLAG, ERRORS, DETAILS)


def rejected(
    marked: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    registry: RuleRegistry | None = None,
    details: bool = False,
) -> DataFrame:
    """The other rows, with the original columns and their errors, which only they are given."""
    if ERRORS in marked.columns:
        return marked.filter(~F.col(VALID_FLAG)).drop(VALID_FLAG)
    return with_errors(marked.filter(~F.col(VALID_FLAG)).drop(VALID_FLAG), entries, registry, details)


def split(
    df: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    registry: RuleRegistry | None = None,
    details: bool = False,
) -> Split:
    marked = mark(df, entries, registry)
    return Split(accepted(marked), rejected(marked, entries, registry, details))


def _corrupt_record_rule(df: DataFrame) -> list[BoundRule]:
    """Lines the reader could not parse are rejects."""
    name = df.sparkSession.conf.get(CORRUPT_CONF)
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
        return []
    message = F.when(F.col(name).isNotNull(), F.lit("record could not be parsed"))
    return [BoundRule(name, "corruptRecord", message)]


def _error_map(first: Mapping[str, Column]) -> Column:
    """The given message of each failing field.

    A concatenation of one-entry maps stays inside generated code, which a filter with a lambda
    would not.
    """
    empty = F.create_map().cast(ERRORS_TYPE)
    parts = [
        F.when(message.isNotNull(), F.create_map(F.lit(field), message)).otherwise(empty)
        for field, message in first.items()
    ]
    return F.map_concat(*parts).cast(ERRORS_TYPE) if parts else empty


def _details(bound: list[BoundRule]) -> Column:
    """Every failing rule in declared order."""
    empty = F.array().cast(DETAILS_TYPE)
    parts = []
    for rule in bound:
        failure = F.struct(
            F.lit(rule.field).alias("field"),
            F.lit(rule.rule).alias("rule"),
            rule.message.alias("message"),
        )
        parts.append(F.when(rule.message.isNotNull(), F.array(failure)).otherwise(empty))
    return F.concat(*parts).cast(DETAILS_TYPE) if parts else empty
