import random

import pytest

from recordflow import SpecError
from recordflow.operators.windows import window
from tests.conftest import rows

SPREAD = {"hotRows": 24}


def params(function, **extra):
    base = {"partitionBy": ["k"], "orderBy": ["o"], "function": function, "alias": "w"}
    if function in ("lag", "lead"):
        base["column"] = "v"
    return {**base, **extra}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key, NULL, has most rows; another is just over the limit; most are small."""
    rng = random.Random(7)
    keys = [None] * 150 + ["b"] * 25 + [f"k{i % 12}" for i in range(60)]
    data = [
        (i, key, rng.choice([None, *range(12)]), round(rng.random(), 3)) for i, key in enumerate(keys)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id int, k string, o int, v double").repartition(5)


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("function", ["rank", "dense_rank"])
def test_spread_ranks_equal_plain_ranks(skewed, area, function, desc):
    order = [{"column": "o", "desc": desc}]
    plain = window(skewed, params(function, orderBy=order))
    spread = window(skewed, params(function, orderBy=order, **SPREAD), area)
    assert spread.columns == plain.columns
    assert dict(spread.dtypes) == dict(plain.dtypes)
    assert rows(spread) == rows(plain)


UP = ["o", "id"]
DOWN = [{"column": "o", "desc": True}, {"column": "id", "desc": True}]


@pytest.mark.parametrize(
    "function, extra, order",
    [
        ("row_number", {}, UP),
        ("row_number", {}, DOWN),
        ("lag", {"offset": 7}, DOWN),
        ("lag", {"offset": 90}, UP),
        ("lead", {}, UP),
        ("lead", {"offset": 33}, DOWN),
        ("lead", {"offset": -2}, UP),
    ],
)
def test_spread_positions_equal_plain_positions(skewed, area, function, extra, order):
    plain = window(skewed, params(function, orderBy=order, **extra))
    spread = window(skewed, params(function, orderBy=order, **extra, **SPREAD), area)
    assert spread.columns == plain.columns
    assert dict(spread.dtypes) == dict(plain.dtypes)
    assert rows(spread) == rows(plain)


@pytest.mark.parametrize("function", ["rank", "lead"])
def test_spread_over_the_whole_table(skewed, area, function):
    extra = {"partitionBy": [], "allowGlobal": True, "orderBy": ["o"] if "rank" in function else ["id"]}
    assert rows(window(skewed, params(function, **extra, **SPREAD), area)) == rows(
        window(skewed, params(function, **extra))
    )


def test_equal_rows_are_numbered_once_each(spark, area):
    copies = spark.createDataFrame([("a", 1, 0.5)] * 200 + [("b", 1, 0.5)] * 3, "k string, o int, v double")
    numbered = window(copies, params("row_number", **SPREAD), area)
    assert sorted(r["w"] for r in numbered.filter("k = 'a'").collect()) == list(range(1, 201))
    assert sorted(r["w"] for r in numbered.filter("k = 'b'").collect()) == [1, 2, 3]
    ranked = window(copies, params("rank", **SPREAD), area)
    assert {r["w"] for r in ranked.collect()} == {1}
    assert ranked.count() == 203


def test_alias_may_replace_a_column(skewed, area):
    for function in ("row_number", "rank"):
        assert window(skewed, params(function, alias="v", **SPREAD), area).columns == ["id", "k", "o", "v"]


def test_no_job_for_a_planned_window(spark):
    data = spark.range(100).selectExpr("id", "id % 2 AS k", "id AS o", "0.5 AS v")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    window(data, params("rank", **SPREAD), planned=True)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)


def test_hot_keys_are_spread_without_an_area_of_the_caller(skewed):
    spread = window(skewed, params("rank", **SPREAD))
    assert "__range" in spread._jdf.queryExecution().analyzed().toString()
    assert rows(spread) == rows(window(skewed, params("rank")))


@pytest.mark.parametrize("function", ["row_number", "rank", "dense_rank"])
def test_positions_are_bigint_in_every_form(skewed, area, function):
    types = {dict(window(skewed, params(function, **extra), area).dtypes)["w"] for extra in ({}, SPREAD)}
    assert types == {"bigint"}


@pytest.mark.parametrize(
    "change",
    [
        {"function": "ntile"},
        {"alias": None},
        {"orderBy": []},
        {"partitionBy": []},
        {"partitionBy": ["nope"]},
        {"orderBy": ["nope"]},
        {"function": "lag", "column": None},
        {"function": "lead", "column": "nope"},
    ],
)
def test_bad_windows(skewed, change):
    with pytest.raises(SpecError):
        window(skewed, {**params("rank"), **change})
