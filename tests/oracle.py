"""Compare a Spark result with the result of its SQL on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
# How the types of the two engines correspond.
TYPE_NAMES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs in schema or rows; an empty list when the results are equal."""
    found = []
    cursor = connection.execute(sql)
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    order = sorted(df.columns)
    if order != sorted(expected_types):
        return [f"columns {order} != {sorted(expected_types)}"]
    for field in df.schema:
        name = field.dataType.simpleString()
        ours = TYPE_NAMES.get(name, name.upper())
        theirs = expected_types[field.name].replace(" ", "")
        if ours != theirs:
            found.append(f"type of {field.name}: {ours} != {theirs}")
    names = [column[0] for column in cursor.description]
    expected = _sorted([[row[names.index(name)] for name in order] for row in cursor.fetchall()])
    actual = _sorted([[row[name] for name in order] for row in df.collect()])
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows != {len(expected)} rows")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}")
    return found


def _sorted(rows):
    return sorted([_plain(value) for value in row] for row in rows)


def _plain(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)
