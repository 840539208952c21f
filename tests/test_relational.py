import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recordflow import SpecError
from recordflow.operators import projections, relational
from tests.conftest import rows


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "c", 30), (None, "d", 40)], "k int, v string, n int")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(2, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0), (None, "w", 4.0)], "k int, v string, r double")


PAIRS = {
    "inner": [(2, "b", 20, "x", 1.0), (2, "b", 20, "y", 2.0), (2, "c", 30, "x", 1.0), (2, "c", 30, "y", 2.0)],
}
LEFT_ONLY = [(1, "a", 10, None, None), (None, "d", 40, None, None)]
RIGHT_ONLY = [(3, None, None, "z", 3.0), (None, None, None, "w", 4.0)]


@pytest.mark.parametrize("skew", [{}, {"hotRows": 1}])
@pytest.mark.parametrize(
    "how, expected",
    [
        ("inner", PAIRS["inner"]),
        ("left", PAIRS["inner"] + LEFT_ONLY),
        ("right", PAIRS["inner"] + RIGHT_ONLY),
        ("full", PAIRS["inner"] + LEFT_ONLY + RIGHT_ONLY),
        ("semi", [(2, "b", 20), (2, "c", 30)]),
        ("anti", [(1, "a", 10), (None, "d", 40)]),
    ],
)
def test_join(left, right, how, expected, skew):
    joined = relational.join(left, right, {"on": ["k"], "how": how, **skew}, look_for_skew=bool(skew))
    if how not in ("semi", "anti"):
        assert joined.columns == ["k", "v", "n", "v_right", "r"]
    assert rows(joined) == sorted(expected, key=repr)


@pytest.mark.parametrize("skew", [{}, {"hotRows": 1}])
@pytest.mark.parametrize("how, size", [("inner", 2), ("left", 4), ("right", 5), ("full", 7), ("semi", 2), ("anti", 2)])
def test_join_with_condition(left, right, how, size, skew):
    params = {"on": ["k"], "how": how, "condition": "l.n / 10 > r.r AND r.v = 'x'", **skew}
    assert relational.join(left, right, params, look_for_skew=bool(skew)).count() == size


def test_join_on_different_names_and_itself(left):
    params = {"on": [{"left": "n", "right": "n2"}]}
    other = left.withColumnRenamed("n", "n2")
    assert relational.join(left, other, params).columns == ["k", "v", "n", "k_right", "v_right", "n2"]
    assert relational.join(left, left.groupBy("k").count(), {"on": ["k"], "how": "left"}).count() == 4


def test_join_broadcast_only_below_the_limit(spark, left, right, caplog):
    known_size = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(k, w)")

    def plan(side=known_size, **params):
        joined = relational.join(left, side, {"on": ["k"], "broadcast": True, **params})
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan()
    assert "strategy=broadcast" not in plan(maxBroadcastBytes=1)
    assert "strategy=broadcast" not in plan(right)
    assert "broadcast hint ignored" in caplog.text


def test_bad_joins(left, right):
    for params in ({"on": []}, {"on": ["k"], "how": "cross"}, {"on": ["nope"]}, {"condition": "l.k < r.k"}):
        with pytest.raises(SpecError):
            relational.join(left, right, params)


def test_union(left, right):
    assert relational.union([left, left.select("n", "v", "k")], {}).count() == 8
    assert relational.union([left, left], {"distinct": True}).count() == 4
    merged = relational.union([left, right], {"allowMissing": True})
    assert merged.columns == ["k", "v", "n", "r"] and merged.count() == 8
    with pytest.raises(SpecError):
        relational.union([left, right], {})


def test_deduplicate(left):
    assert relational.deduplicate(left, {"subset": ["k"]}).count() == 3
    assert relational.deduplicate(left.unionByName(left), {}).count() == 4
    assert relational.deduplicate(left.select("k", "n"), {"subset": ["K"]}).count() == 3
    first = relational.deduplicate(left, {"subset": ["k"], "orderBy": ["n"]})
    last = relational.deduplicate(left, {"subset": ["k"], "orderBy": [{"column": "n", "desc": True}]})
    assert [r["v"] for r in first.filter("k = 2").collect()] == ["b"]
    assert [r["v"] for r in last.filter("k = 2").collect()] == ["c"]
    with pytest.raises(SpecError):
        relational.deduplicate(left, {"subset": ["nope"]})


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=20))
def test_deduplicate_is_idempotent_and_keeps_every_key(spark, data):
    df = spark.createDataFrame(data, "a int, b int, n int")
    params = {"subset": ["a", "b"], "orderBy": ["n"]}
    once = relational.deduplicate(df, params)
    assert rows(relational.deduplicate(once, params)) == rows(once)
    keys = {(a, b) for a, b, _ in data}
    smallest = [(*key, min(n for a, b, n in data if (a, b) == key)) for key in keys]
    assert rows(once) == sorted(smallest, key=repr)


def test_aggregate(spark):
    data = spark.createDataFrame(
        [("g", 1, "2.5", "b"), ("g", None, "x", "a"), ("h", 3, None, None)], "g string, n int, t string, s string"
    )
    params = {
        "groupBy": ["g"],
        "aggregations": [
            {"function": "sum", "column": "n"},
            {"function": "avg", "column": "n", "alias": "mean"},
            {"function": "count", "column": "n"},
            {"function": "count", "column": "*", "alias": "rows"},
            {"function": "min", "column": "s"},
            {"function": "max", "column": "s"},
            {"function": "sum", "column": "t"},
        ],
    }
    result = relational.aggregate(data, params)
    assert result.columns == ["g", "sum_n", "mean", "count_n", "rows", "min_s", "max_s", "sum_t"]
    assert rows(result) == [("g", 1, 1.0, 1, 2, "a", "b", 2.5), ("h", 3, 3.0, 1, 1, None, None, None)]


@pytest.mark.parametrize(
    "params",
    [
        {"groupBy": [], "aggregations": [{"function": "sum", "column": "n"}]},
        {"groupBy": ["k"], "aggregations": []},
        {"groupBy": ["k"], "aggregations": [{"function": "median", "column": "n"}]},
        {"groupBy": ["k"], "aggregations": [{"function": "sum", "column": "nope"}]},
        {"groupBy": ["k"], "aggregations": [{"function": "sum", "column": "*"}]},
        {"groupBy": ["nope"], "aggregations": [{"function": "sum", "column": "n"}]},
    ],
)
def test_bad_aggregates(left, params):
    with pytest.raises(SpecError):
        relational.aggregate(left, params)


@pytest.mark.parametrize("desc", [False, True])
def test_pivot_takes_the_first_by_an_order(spark, desc):
    data = [(i % 3, "xy"[i % 2], i * 7 % 20, i) for i in range(60)] + [(1, "x", None, 99), (None, "y", 3, 98)]
    df = spark.createDataFrame(data, "g int, p string, o int, n int").repartition(7)
    params = {"groupBy": ["g"], "pivotColumn": "p", "valueColumn": "n", "orderBy": [{"column": "o", "desc": desc}, "n"]}
    first = {}
    # NULL comes first in ascending order and last in descending order.
    for g, p, o, n in sorted(data, key=lambda r: ((r[2] is not None) != desc, 0 if r[2] is None else -r[2] if desc else r[2], r[3])):
        first.setdefault((g, p), n)
    assert rows(relational.pivot(df, params)) == sorted(((g, first.get((g, "x")), first.get((g, "y"))) for g in (None, 0, 1, 2)), key=repr)
    with pytest.raises(SpecError, match="orderBy"):
        relational.pivot(df, {**params, "aggregate": "max"})


def test_pivot(spark):
    data = spark.createDataFrame(
        [("g", "x", 1), ("g", "y", 2), ("h", "x", 3), ("h", None, 4)], "g string, p string, n int"
    )
    found = relational.pivot(data, {"groupBy": ["g"], "pivotColumn": "p", "valueColumn": "n"})
    assert found.columns == ["g", "null", "x", "y"]
    assert rows(found) == [("g", None, 1, 2), ("h", 4, 3, None)]
    given_values = {"groupBy": ["g"], "pivotColumn": "p", "valueColumn": "n", "values": ["y"], "aggregate": "max"}
    assert rows(relational.pivot(data, given_values)) == [("g", 2), ("h", None)]
    assert rows(relational.pivot(data, {"pivotColumn": "g", "valueColumn": "n", "aggregate": "sum"})) == [(3, 7)]
    with pytest.raises(SpecError, match="more than 1"):
        relational.pivot_values(data, "p", limit=1)
    for params in ({"pivotColumn": "p"}, {"pivotColumn": "p", "valueColumn": "n", "aggregate": "mode"}):
        with pytest.raises(SpecError):
            relational.pivot(data, params)


def test_rename(left):
    renamed = projections.rename_columns(left, {"mapping": {"k": "a", "a": "b", "n": "k"}})
    assert renamed.columns == ["b", "v", "k"]
    assert projections.rename_columns(left, {"mapping": {"zz": "a"}, "onMissing": "skip"}).columns == left.columns
    for mapping in ({"zz": "a"}, {"k": "v"}):
        with pytest.raises(SpecError):
            projections.rename_columns(left, {"mapping": mapping})


def test_drop_and_select(left):
    assert projections.drop_columns(left, {"columns": ["v"]}).columns == ["k", "n"]
    assert projections.drop_columns(left, {"columns": ["v", "zz"], "onMissing": "skip"}).columns == ["k", "n"]
    assert projections.select_columns(left, {"columns": ["n", "k"]}).columns == ["n", "k"]
    assert projections.select_columns(left, {"columns": ["n", "zz"], "onMissing": "skip"}).columns == ["n"]
    for step in (projections.drop_columns, projections.select_columns):
        with pytest.raises(SpecError):
            step(left, {"columns": ["zz"]})
    with pytest.raises(SpecError):
        projections.select_columns(left, {"columns": ["zz"], "onMissing": "skip"})


def test_filter_drops_unknown(left):
    assert projections.filter_rows(left, {"condition": "k > 1"}).count() == 2
    with pytest.raises(SpecError):
        projections.filter_rows(left, {})
