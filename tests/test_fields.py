import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from recordflow import FieldRegistry, SpecError
from recordflow.operators.projections import add_fields

RUN_TIME = datetime.datetime(2025, 11, 19, 10, 21, 42, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [
            (1, "Ab", " c ", 7, "12.9", "2024-02-29", datetime.date(2024, 3, 2)),
            (2, None, "x", None, "1e3", "no date", datetime.date(2023, 12, 31)),
            (3, "", None, -7, " 8 ", None, None),
        ],
        "id int, a string, b string, n int, t string, d string, e date",
    )


def values(data, function, run_time=None, registry=None, **params):
    added = add_fields(
        data, {"addFields": [{"name": "out", "function": function, **params}]}, registry, run_time
    )
    return [row["out"] for row in added.orderBy("id").collect()]


@pytest.mark.parametrize(
    "function, params, expected",
    [
        ("literal", {"value": "v"}, ["v"] * 3),
        ("literal", {"value": 0}, [0] * 3),
        ("concat", {"columns": ["a", "b"]}, ["Ab c ", None, None]),
        ("concat", {"columns": ["a", "b", "n"], "separator": "-"}, ["Ab- c -7", "x", "--7"]),
        ("substring", {"column": "t", "start": 2}, ["2.9", "e3", "8 "]),
        ("substring", {"column": "t", "start": 1, "length": 2}, ["12", "1e", " 8"]),
        ("substring", {"column": "t", "length": 0}, ["12.9", "1e3", " 8 "]),
        ("substring", {"column": "t", "start": -2}, [".9", "e3", "8 "]),
        ("upper", {"column": "a"}, ["AB", None, ""]),
        ("lower", {"column": "a"}, ["ab", None, ""]),
        ("trim", {"column": "b"}, ["c", "x", None]),
        ("upper", {"column": "n"}, ["7", None, "-7"]),
        ("cast", {"column": "t", "type": "int"}, [12, None, 8]),
        ("cast", {"column": "t", "type": "double"}, [12.9, 1000.0, 8.0]),
        ("cast", {"column": "d", "type": "date"}, [datetime.date(2024, 2, 29), None, None]),
        ("cast", {"column": "n", "type": "string"}, ["7", None, "-7"]),
        ("coalesce", {"columns": ["a", "b"]}, ["Ab", "x", ""]),
        ("coalesce", {"columns": ["n", "t"]}, ["7", "1e3", "-7"]),
        ("when", {"condition": "n > 0", "then": "pos", "otherwise": "neg"}, ["pos", "neg", "neg"]),
        ("when", {"condition": "n > 0", "then": 0}, [0, None, None]),
        ("year", {"column": "d"}, [2024, None, None]),
        ("month", {"column": "e"}, [3, 12, None]),
        ("day", {"column": "d"}, [29, None, None]),
        ("datediff", {"start_date": "d", "end_date": "e"}, [2, None, None]),
        ("expr", {"expression": "n * 2"}, [14, None, -14]),
        ("lookup", {"column": "a", "mapping": {"Ab": 1, "": 2}}, [1, None, 2]),
        ("lookup", {"column": "a", "mapping": {"Ab": 1}, "default": 9}, [1, 9, 9]),
        ("lookup", {"column": "n", "mapping": {"7": "p", "x": "never", "7.0": "late"}, "default": "d"}, ["p", "d", "d"]),
        ("lookup", {"column": "a", "mapping": {"Ab": None}, "default": "d"}, [None, "d", "d"]),
        ("lookup", {"column": "a", "mapping": {"Ab": 1, "": "two"}, "default": True}, ["1", "true", "two"]),
        ("lookup", {"column": "n", "mapping": {"x": 1}, "default": 3}, [3, 3, 3]),
    ],
)
def test_function(data, function, params, expected):
    assert values(data, function, **params) == expected


@pytest.mark.parametrize("algorithm", ["md5", "sha1", "sha256", "sha512"])
def test_hash(data, algorithm):
    expected = [hashlib.new(algorithm, text.encode()).hexdigest() for text in ("Ab|| c ||7", "x", "||-7")]
    assert values(data, "hash", columns=["a", "b", "n"], algorithm=algorithm) == expected


def test_hash_defaults_to_sha256_and_can_tell_nulls_apart(data):
    assert values(data, "hash", columns=["b"])[1] == hashlib.sha256(b"x").hexdigest()
    assert values(data, "hash", columns=["a", "b"], nullToken="~")[1] == hashlib.sha256(b"~||x").hexdigest()


def test_uuid(data):
    ids = values(data, "uuid")
    assert len(set(ids)) == 3
    assert all(re.fullmatch("[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", i) for i in ids)


def test_run_time_is_one_value(data):
    assert values(data, "current_date", run_time=RUN_TIME) == [datetime.date(2025, 11, 19)] * 3
    times = values(data, "current_timestamp", run_time=RUN_TIME)
    assert len(set(times)) == 1
    assert {type(v) for v in values(data, "current_timestamp")} == {datetime.datetime}


@pytest.mark.parametrize(
    "function, params",
    [
        ("nope", {}), ("literal", {}), ("hash", {}), ("hash", {"columns": ["a"], "algorithm": "crc"}), ("concat", {}),
        ("substring", {}), ("upper", {}), ("cast", {"column": "a"}), ("coalesce", {"columns": []}),
        ("when", {"condition": "true"}), ("year", {}), ("datediff", {"start_date": "d"}), ("expr", {}),
        ("lookup", {"column": "a"}),
    ],
)
def test_missing_parameters(data, function, params):
    with pytest.raises(SpecError):
        values(data, function, **params)


def test_large_lookup_is_a_join_with_the_same_result(data):
    mapping = {str(key): f"v{key % 5}" for key in range(1500)} | {"-7": None}
    assert values(data, "lookup", column="n", mapping=mapping, default="d") == ["v2", "d", None]
    assert values(data, "lookup", column="n", mapping=mapping) == ["v2", None, None]
    added = add_fields(data, {"addFields": [{"name": "a", "function": "lookup", "column": "n", "mapping": mapping}]})
    assert added.columns == data.columns


def test_later_fields_see_earlier_ones(data):
    fields = [
        {"name": "a", "function": "upper", "column": "a"},
        {"name": "ab", "function": "expr", "expression": "concat(a, '!')"},
        {"name": "ab", "function": "concat", "columns": ["ab", "ab"]},
        {"name": "size", "function": "when", "condition": "length(AB) > 4", "then": "long"},
    ]
    added = add_fields(data, {"addFields": fields})
    assert added.columns == [*data.columns, "ab", "size"]
    first = added.orderBy("id").first()
    assert (first["a"], first["ab"], first["size"]) == ("AB", "AB!AB!", "long")


def test_independent_fields_are_one_projection(data):
    fields = [{"name": f"f{i}", "function": "upper", "column": "a"} for i in range(50)]
    plan = add_fields(data, {"addFields": fields})._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_own_function(data):
    registry = FieldRegistry()
    registry.register("twice", lambda df, params: F.col(params["column"]) * 2)
    assert "twice" in registry.names()
    assert values(data, "twice", registry=registry, column="n") == [14, None, -14]


def test_catalogue():
    assert FieldRegistry().names() == [
        "current_timestamp", "current_date", "literal", "uuid", "hash", "concat", "substring", "upper", "lower",
        "trim", "cast", "coalesce", "when", "year", "month", "day", "datediff", "expr", "lookup",
    ]
