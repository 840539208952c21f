"""Queries over the test tables, one or more per operator, each with its SQL where SQL can say it."""

from workload import audit, fields, files, flagship, ranges, relational, validation  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
