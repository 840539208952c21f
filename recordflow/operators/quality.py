"""Data-quality measures, gates and the run report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.errors import QualityGateError
from recordflow.functions.columns import column_of, known_columns
from recordflow.operators.validate import ERRORS, VALID_FLAG

DEFAULT_MIN_VALID_PERCENTAGE = 80


@dataclass(frozen=True)
class Gate:
    name: str
    value: float | None
    limit: float
    passed: bool
    message: str


def summary(marked: DataFrame) -> DataFrame:
    """One row: total, valid and invalid rows and the valid percentage (NULL for no rows)."""
    counts = marked.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(VALID_FLAG)).alias("valid_records"),
        F.count_if(~F.col(VALID_FLAG)).alias("invalid_records"),
    )
    return counts.withColumn("valid_percentage", _percentage("valid_records", "total_records"))


def duplicates(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row: total rows, distinct keys and the percentage of rows beyond the first per key.

    Keys are counted before the shuffle, so a hot key costs one row per task.
    """
    keys = known_columns(df, keys, "duplicates") or df.columns
    per_key = df.groupBy(*[column_of(df, key) for key in keys]).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )
    extra = F.col("total_records") - F.col("distinct_keys")
    return counts.withColumn("duplicate_records", extra).withColumn(
        "duplicate_percentage", _percentage("duplicate_records", "total_records")
    )


def reject_breakdown(rejects: DataFrame) -> DataFrame:
    """Rows per field and message of a reject table."""
    return (
        rejects.select(F.explode(ERRORS).alias("field", "message"))
        .groupBy("field", "message")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def min_valid_gate(measured: Mapping[str, Any], minimum: float = DEFAULT_MIN_VALID_PERCENTAGE) -> Gate:
    """The valid percentage must reach the minimum; a table without rows fails."""
    value = measured["valid_percentage"]
    if not measured["total_records"]:
        return Gate("min_valid_record_percentage", None, minimum, False, "No records processed")
    passed = value >= minimum
    return Gate(
        "min_valid_record_percentage", value, minimum, passed, f"{value:.2f}% valid records (minimum: {minimum}%)"
    )


def max_duplicate_gate(measured: Mapping[str, Any], maximum: float) -> Gate:
    """The duplicate percentage must not exceed the maximum."""
    value = measured["duplicate_percentage"] or 0.0
    passed = value <= maximum
    return Gate(
        "max_duplicate_percentage", value, maximum, passed, f"{value:.2f}% duplicate records (maximum: {maximum}%)"
    )


def require(gates: Sequence[Gate]) -> None:
    failed = [gate.message for gate in gates if not gate.passed]
    if failed:
        raise QualityGateError("Quality check failed: " + "; ".join(failed))


def _percentage(part: str, whole: str):
    # The whole is never 0 inside the branch, so there is no division by zero to guard in ANSI mode.
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100)
