"""Range joins against all pairs compared one by one."""

import datetime
import itertools
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordflow.errors import SpecError
from recordflow.operators import ranges, relational
from recordflow.plans.flow import CompiledFlow

HOWS = ("inner", "left", "right", "full", "semi", "anti")


def expected(left, right, test, how):
    """Rows of two lists of tuples; a side without a partner has None for the other."""
    pairs = [(a, b) for a, b in itertools.product(left, right) if test(a, b)]
    if how in ("semi", "anti"):
        return sorted([a for a in left if any(test(a, b) for b in right) == (how == "semi")], key=repr)
    out = [(*a, *b) for a, b in pairs]
    if how in ("left", "full"):
        out += [(*a, *(None,) * 3) for a in left if not any(test(a, b) for b in right)]
    if how in ("right", "full"):
        out += [(*(None,) * len(a0), *b) for b in right for a0 in [left[0]] if not any(test(a, b) for a in left)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def within(closed_low=True, closed_high=True):
    def test(a, b):
        v, low, high = a[1], b[1], b[2]
        if v is None or low is None or high is None:
            return False
        return (low <= v if closed_low else low < v) and (v <= high if closed_high else v < high)

    return test


def sides(rng, make):
    left = [(i, make(rng.randint(-60, 60))) for i in range(40)] + [(40, None), (41, make(5)), (41, make(5))]
    right = []
    for i in range(30):
        low = rng.randint(-60, 60)
        right.append((100 + i, make(low), make(low + rng.choice([0, 0, 1, 2, 3, 7, 30, 200, -4]))))
    return left, [*right, (200, None, make(3)), (201, make(-10), None)]


DAY = datetime.date(2024, 2, 28)
MAKERS = {
    "long": (lambda x: x, "bigint"),
    "int": (lambda x: x * 7, "int"),
    "double": (lambda x: x / 16, "double"),
    "tiny": (lambda x: x * 1e-12, "double"),
    "decimal": (lambda x: Decimal(x).scaleb(-2), "decimal(10,2)"),
    "date": (lambda x: DAY + datetime.timedelta(days=x), "date"),
    "timestamp": (lambda x: datetime.datetime(2024, 3, 31) + datetime.timedelta(minutes=x), "timestamp"),
    "timestamp_ntz": (lambda x: datetime.datetime(2024, 3, 31) + datetime.timedelta(seconds=x), "timestamp_ntz"),
}


@pytest.mark.parametrize("kind", MAKERS)
@pytest.mark.parametrize("measured", [True, False])
def test_kinds_of_values(spark, kind, measured):
    make, sql = MAKERS[kind]
    left, right = sides(random.Random(kind), make)
    l_df = spark.createDataFrame(left, f"k int, v {sql}")
    r_df = spark.createDataFrame(right, f"w int, low {sql}, high {sql}")
    params = {"between": {"value": "v", "low": "low", "high": "high"}}
    assert got(relational.join(l_df, r_df, params, look_for_skew=measured)) == expected(left, right, within(), "inner")


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("bounds", ranges.BOUNDS)
def test_types_and_bounds(spark, how, bounds):
    left, right = sides(random.Random(how), lambda x: x)
    l_df, r_df = spark.createDataFrame(left, "k int, v long"), spark.createDataFrame(right, "w int, low long, high long")
    params = {"between": {"value": "v", "low": "low", "high": "high", "bounds": bounds}, "how": how}
    test = within(bounds[0] == "[", bounds[1] == "]")
    if bounds == "()":
        test = within(False, False)
    assert got(relational.join(l_df, r_df, params)) == expected(left, right, test, how)


@pytest.mark.parametrize("how", HOWS)
def test_value_on_the_right_with_condition_and_key(spark, how):
    points, spans = sides(random.Random(4), lambda x: x)
    l_df = spark.createDataFrame(spans, "w int, low long, high long").withColumn("g", F.col("w") % 3)
    r_df = spark.createDataFrame(points, "k int, v long").withColumn("g", F.col("k") % 3)
    params = {"between": {"value": "v", "low": "low", "high": "high", "side": "right"}, "on": ["g"], "condition": "l.w % 5 <> r.k % 5", "how": how}
    joined = relational.join(l_df, r_df, params)
    test = lambda s, p: within()(p, s) and s[0] % 3 == p[0] % 3 and s[0] % 5 != p[0] % 5
    pairs = [(s, p) for s in spans for p in points if test(s, p)]
    matched_s, matched_p = {s for s, _ in pairs}, {p for _, p in pairs}
    rows = sorted([(r["w"], r["k"] if how not in ("semi", "anti") else None) for r in joined.collect()], key=repr)
    if how in ("semi", "anti"):
        wanted = [(s[0], None) for s in spans if (s in matched_s) == (how == "semi")]
    else:
        wanted = [(s[0], p[0]) for s, p in pairs]
        wanted += [(s[0], None) for s in spans if s not in matched_s] if how in ("left", "full") else []
        wanted += [(None, p[0]) for p in points if p not in matched_p] if how in ("right", "full") else []
    assert rows == sorted(wanted, key=repr)


@pytest.mark.parametrize("bounds", ["[]", "()"])
@pytest.mark.parametrize("measured", [True, False])
def test_overlaps_of_all_lengths(spark, bounds, measured):
    rng = random.Random(bounds)
    make = lambda n: [(i, a := rng.randint(-(2**20), 2**20), a + rng.choice([0, 1, 3, 100, 5000, 2**19, 2**40])) for i in range(n)]
    left, right = make(60), make(60)
    edge = (2**63 - 1, -(2**63))
    left += [(90, edge[1], edge[0]), (91, 2**60 - 1, 2**61), (92, edge[0], edge[0])]
    right += [(93, 2**60, 2**60), (94, edge[1], -5), (95, 2**62, edge[0])]
    l_df, r_df = (spark.createDataFrame(x, "k int, a long, b long") for x in (left, right))
    params = {"overlaps": {"left": ["a", "b"], "right": ["a", "b"], "bounds": bounds}}
    test = (lambda x, y: x[1] <= y[2] and y[1] <= x[2]) if bounds == "[]" else (lambda x, y: x[1] < y[2] and y[1] < x[2])
    assert got(relational.join(l_df, r_df, params, look_for_skew=measured)) == expected(left, right, test, "inner")


def test_numbers_without_an_end(spark):
    left = [(1, math.inf), (2, -math.inf), (3, 0.0), (4, -0.0), (5, 1e308), (6, 5e-324)]
    right = [(10, -math.inf, math.inf), (11, 0.0, 0.0), (12, 1e300, math.inf), (13, -1.0, -0.0)]
    l_df, r_df = spark.createDataFrame(left, "k int, v double"), spark.createDataFrame(right, "w int, low double, high double")
    joined = relational.join(l_df, r_df, {"between": {"value": "v", "low": "low", "high": "high"}})
    assert got(joined.select("k", "w")) == sorted([(a[0], b[0]) for a in left for b in right if b[1] <= a[1] <= b[2]], key=repr)


def test_plan_compares_no_all_pairs(spark, sf_dir):
    from workload import QUERIES

    for name in ("join_range", "join_range_left", "join_range_anti", "join_overlaps"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_a_row_is_copied_twice_per_level_at_most(spark):
    df = spark.range(1000).selectExpr("id * 37 AS a", "id * 37 + id * id AS b")
    side = ranges._Side(df, "l", ["a", "b"], True)
    levels = side.levels()
    assert side.in_bins([]).groupBy("l").count().agg(F.max("count")).first()[0] == 2
    assert side.in_bins(levels).groupBy("l").count().agg(F.max("count")).first()[0] <= 2 * len(levels)


def binned_rows(monkeypatch):
    """The frames of rows in bins that a join was made of, in order."""
    made, in_bins = [], ranges._Side.in_bins
    monkeypatch.setattr(ranges._Side, "in_bins", lambda self, others: made.append(in_bins(self, others)) or made[-1])
    return made


@pytest.mark.parametrize("hot", [False, True])
def test_rows_that_meet_few_others_are_copied_for_no_levels(spark, monkeypatch, hot):
    """Intervals of many lengths, on few days of many users; of one user only, they go to the bins of their levels again."""
    rng = random.Random(3)
    make = lambda: [(1 if hot else i % 100, i, a := rng.randint(0, 2**25 if hot else 2**30), a + rng.choice([0, 0, 0, 50, 9000, 2**16, 2**22])) for i in range(1500)]
    left, right = make(), make()
    l_df, r_df = (spark.createDataFrame(x, "u int, k int, a long, b long") for x in (left, right))
    made = binned_rows(monkeypatch)
    params = {"on": ["u"], "overlaps": {"left": ["a", "b"], "right": ["a", "b"]}}
    joined = relational.join(l_df, r_df, params, look_for_skew=True)
    test = lambda x, y: x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3]
    assert rows_of(joined, "k", "k_right") == sorted((x[1], y[1]) for x in left for y in right if test(x, y))
    copies = sum(frame.count() for frame in made[-2:]) / 3000
    assert copies > 3 if hot else copies < 1.5


def test_lazy_rows_go_to_levels_that_occur(spark, monkeypatch):
    """Planned without a job, values are copied for the levels of the intervals, and these for none but their own."""
    points = spark.range(500).selectExpr("id AS k", "id AS v")
    spans = spark.range(60).selectExpr("id AS w", "id * 8 AS low", "id * 8 + IF(id % 2 = 0, 3, 40) AS high")
    made = binned_rows(monkeypatch)
    context = spark.sparkContext
    context.setJobGroup("lazy range join", "none is started")
    joined = relational.join(points, spans, {"between": {"value": "v", "low": "low", "high": "high"}, "how": "left"})
    assert list(context.statusTracker().getJobIdsForGroup("lazy range join")) == []
    context.setLocalProperty("spark.jobGroup.id", None)
    assert [frame.groupBy(frame[0]).count().agg(F.max("count")).first()[0] for frame in made] == [3, 2]
    spans_now = [(r["w"], r["low"], r["high"]) for r in spans.collect()]
    assert got(joined.where("w IS NOT NULL").select("k", "w")) == sorted(((v, w) for v in range(500) for w, low, high in spans_now if low <= v <= high), key=repr)
    assert joined.where("w IS NULL").count() == sum(not any(low <= v <= high for _, low, high in spans_now) for v in range(500))
    drawn = spans.withColumn("high", F.expr("low + cast(1000 * rand() AS long)"))
    assert ranges._Side(drawn, "r", ["low", "high"], True).possible_levels() == list(ranges.LEVELS)
    assert ranges._Side(drawn, "r", ["low", "low"], True).possible_levels() == [0]


def rows_of(df, *names):
    return sorted(tuple(row[name] for name in names) for row in df.collect())


def test_faults_are_told(spark):
    l_df, r_df = spark.createDataFrame([(1, "x")], "v int, t string"), spark.createDataFrame([(1, 2)], "low int, high int")
    between = {"value": "v", "low": "low", "high": "high"}
    for params, text in (
        ({"condition": "l.v < r.low"}, "between"),
        ({"between": {**between, "value": "t"}}, "string"),
        ({"between": {**between, "value": "nope"}}, "nope"),
        ({"between": {**between, "bounds": "<"}}, "bounds"),
        ({"between": {**between, "side": "up"}}, "side"),
        ({"overlaps": {"left": ["v"], "right": ["low", "high"]}}, "two columns"),
        ({"overlaps": {"left": ["v", "v"], "right": ["low", "high"], "bounds": "[)"}}, "bounds"),
        ({"between": between, "overlaps": {"left": ["v", "v"], "right": ["low", "high"]}}, "either"),
    ):
        with pytest.raises(SpecError, match=text):
            relational.join(l_df, r_df, params)
    dates = spark.sql("SELECT DATE'2024-01-01' AS low, DATE'2024-01-02' AS high")
    with pytest.raises(SpecError, match="date with number"):
        relational.join(l_df, dates, {"between": between})


def test_step_of_a_flow(spark, tmp_path):
    """A spec may leave out ``on`` where it has a range; planning it starts no job, and a run reads each side once."""
    left = spark.createDataFrame([(i, i * 10) for i in range(50)], "k int, v int")
    right = spark.createDataFrame([("a", 95, 120), ("b", 115, 300), ("c", 901, 905)], "w string, low int, high int")
    step = {"name": "in_band", "type": "join", "params": {"input": "points", "right": "bands", "how": "left", "between": {"value": "v", "low": "low", "high": "high"}}}
    spec = {
        "version": "1.0.0",
        "dataflows": [
            {
                "name": "f",
                "sources": [{"name": n, "path": str(tmp_path / n), "format": "JSON"} for n in ("points", "bands")],
                "transformations": [step],
                "sinks": [{"input": "in_band", "name": "out", "paths": [str(tmp_path / "out")], "format": "PARQUET", "saveMode": "OVERWRITE"}],
            }
        ],
    }
    report = CompiledFlow(spark, spec, inputs={"points": left, "bands": right}).run()
    assert report.status == "success"
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["v"], r["w"]) for r in rows.where("w IS NOT NULL").collect()) == [(100, "a"), (110, "a"), (120, "a"), (120, "b"), *((v, "b") for v in range(130, 301, 10))]
    assert rows.count() == 51
    del spec["dataflows"][0]["transformations"][0]["params"]["between"]
    with pytest.raises(SpecError, match="between"):
        CompiledFlow(spark, spec)
