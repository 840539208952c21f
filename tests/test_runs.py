"""Runs over empty branches, rules that answer differently each time, pivots, and one type per lookup."""

import pytest
from pyspark.sql import functions as F

from recordflow import CompiledFlow
from recordflow.operators import projections, relational
from recordflow.plans.staging import is_repeatable
from recordflow.sinks.writers import write_sink
from recordflow.plans.spec import Sink
from tests.conftest import rows

COUNT = [{"function": "count", "column": "*", "alias": "n"}]


def run(spark, inputs, steps, sinks, tmp_path, **settings):
    flow = {
        "name": "t",
        "sources": [{"name": n, "path": "given", "format": "JSON"} for n in inputs],
        "transformations": steps,
        "sinks": [{"input": i, "name": i, "paths": [f"{tmp_path}/{i}"], "format": "PARQUET"} for i in sinks],
        "settings": settings,
    }
    report = CompiledFlow(spark, {"version": "1", "dataflows": [flow]}, inputs=inputs).run()
    return report, {item["name"]: item["record_count"] for item in report.stages[-1]["data"]}


@pytest.mark.parametrize("how,kept", [("inner", 0), ("left", 20), ("full", 20), ("semi", 0), ("anti", 20)])
def test_join_with_an_empty_side(spark, tmp_path, how, kept):
    left, right = spark.range(20).withColumn("a", F.lit(1)), spark.range(0).withColumn("b", F.lit(1))
    step = {"name": "j", "type": "join", "params": {"input": "l", "right": "r", "on": ["id"], "how": how}}
    report, counts = run(spark, {"l": left, "r": right}, [step], ["j"], tmp_path)
    assert report.status == "success" and counts == {"j": kept}
    assert spark.read.parquet(f"{tmp_path}/j").count() == kept and (tmp_path / "j" / "_SUCCESS").exists()


def test_aggregate_of_nothing(spark, tmp_path):
    step = {"name": "g", "type": "aggregate", "params": {"input": "s", "groupBy": ["id"], "aggregations": COUNT}}
    report, counts = run(spark, {"s": spark.range(0)}, [step], ["g"], tmp_path)
    assert report.status == "success" and counts == {"g": 0}


@pytest.mark.parametrize("rule,valid", [("id >= 0", 20), ("id < 0", 0)])
def test_validation_of_one_kind(spark, tmp_path, rule, valid):
    rules = [{"field": "id", "validations": [{"type": "custom", "params": {"expression": rule}}]}]
    steps = [{"name": "v", "type": "validate_fields", "params": {"input": "s", "validations": rules}}]
    for kind in ("ok", "ko"):
        params = {"input": f"validation_{kind}", "groupBy": ["id"], "aggregations": COUNT}
        steps.append({"name": f"g_{kind}", "type": "aggregate", "params": params})
    report, counts = run(spark, {"s": spark.range(20)}, steps, ["g_ok", "g_ko"], tmp_path)
    assert report.status == "success" and counts == {"g_ok": valid, "g_ko": 20 - valid}


@pytest.mark.parametrize("rule", ["rand() < 0.5", "unix_micros(current_timestamp()) % 100 < id"])
@pytest.mark.parametrize("details", [False, True])
def test_split_is_a_partition(spark, tmp_path, rule, details):
    rules = [{"field": "id", "validations": [{"type": "custom", "params": {"expression": rule}}]}]
    step = {"name": "v", "type": "validate_fields", "params": {"input": "s", "validations": rules, "details": details}}
    run(spark, {"s": spark.range(100)}, [step], ["validation_ok", "validation_ko"], tmp_path)
    valid = {r["id"] for r in spark.read.parquet(f"{tmp_path}/validation_ok").collect()}
    bad = spark.read.parquet(f"{tmp_path}/validation_ko").collect()
    assert not valid & {r["id"] for r in bad} and len(valid) + len(bad) == 100
    assert all(r["validation_errors"] for r in bad)


@pytest.mark.parametrize("kind", ["expr", "filter"])
def test_random_steps_agree_in_all_sinks(spark, tmp_path, kind):
    if kind == "expr":
        step = {"name": "x", "type": "add_fields", "params": {"input": "s", "addFields": [{"name": "r", "function": "expr", "expression": "rand()"}]}}
    else:
        step = {"name": "x", "type": "filter", "params": {"input": "s", "condition": "rand() < 0.5"}}
    copy = {"name": "y", "type": "drop_columns", "params": {"input": "x", "columns": []}}
    run(spark, {"s": spark.range(200)}, [step, copy], ["x", "y"], tmp_path)
    assert rows(spark.read.parquet(f"{tmp_path}/x")) == rows(spark.read.parquet(f"{tmp_path}/y"))


def test_repeatable(spark):
    assert is_repeatable(spark.range(3).withColumn("a", F.col("id") + 1))
    for column in (F.rand(), F.current_timestamp(), F.expr("uuid()"), F.expr("now()")):
        assert not is_repeatable(spark.range(3).withColumn("a", column))


@pytest.mark.parametrize("upstream", ["rand", "dedupe"])
def test_pivot_counts_every_row(spark, tmp_path, upstream):
    source = spark.range(400).selectExpr("id", "id % 3 AS g", "id % 40 AS k")
    if upstream == "rand":
        step = {"name": "x", "type": "add_fields", "params": {"input": "s", "addFields": [{"name": "p", "function": "expr", "expression": "concat('c', int(rand() * 200))"}]}}
        total = 400
    else:
        step = {"name": "x", "type": "deduplicate", "params": {"input": "s", "subset": ["k"]}}
        source, total = source.withColumn("p", F.col("id").cast("string")), 40
    pivot = {"name": "w", "type": "pivot", "params": {"input": "x", "groupBy": ["g"], "pivotColumn": "p", "valueColumn": "id", "aggregate": "count"}}
    run(spark, {"s": source}, [step, pivot], ["w"], tmp_path)
    wide = spark.read.parquet(f"{tmp_path}/w").collect()
    assert sum(v or 0 for r in wide for n, v in r.asDict().items() if n != "g") == total


def test_check_starts_no_job(spark, tmp_path):
    pivot = {"name": "w", "type": "pivot", "params": {"input": "s", "groupBy": ["g"], "pivotColumn": "p", "valueColumn": "id"}}
    flow = {"name": "t", "sources": [{"name": "s", "path": "given"}], "transformations": [pivot], "sinks": [{"input": "w", "name": "w", "paths": [f"{tmp_path}/w"]}]}
    compiled = CompiledFlow(spark, {"version": "1", "dataflows": [flow]}, inputs={"s": spark.range(9).selectExpr("id", "id % 2 AS g", "id % 3 AS p")})
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    compiled.check()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_full_join_sets_null_keys_aside(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, v string")
    expected = rows(left.join(right.withColumnRenamed("v", "v_right"), "k", "full"))
    for extra in ({}, {"hotRows": 0}):
        joined = relational.join(left, right, {"on": ["k"], "how": "full", **extra}, look_for_skew=True)
        assert joined.columns == ["k", "v", "v_right"] and rows(joined) == expected


@pytest.mark.parametrize("values", [lambda i: i, lambda i: i * 2**33, lambda i: None if i == 0 else i, lambda i: i if i % 2 else i / 2, lambda i: i if i % 2 else "x", lambda i: i % 2 == 0, lambda i: None])
def test_lookup_is_the_same_at_all_sizes(spark, values):
    data = spark.range(5)
    found = []
    for n in (3, 1000, 1001):
        config = {"name": "f", "function": "lookup", "column": "id", "mapping": {str(i): values(i) for i in range(n)}}
        df = projections.add_fields(data, {"addFields": [config]})
        found.append((df.dtypes, rows(df.filter("id < 3"))))
    assert found[1] == found[2] and found[0][1] == found[1][1]


def test_lookup_of_two_spellings_and_of_no_fitting_key(spark):
    data = spark.sql("SELECT timestamp'2025-01-01 00:00:00' AS t")
    for n in (0, 1001):
        mapping = {"2025-01-01 00:00:00": 1, "2025-01-01T00:00:00": 2} | {f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}": 3 for i in range(n)}
        assert [r["f"] for r in projections.add_fields(data, {"addFields": [{"name": "f", "function": "lookup", "column": "t", "mapping": mapping}]}).collect()] == [1]
        config = {"name": "f", "function": "lookup", "column": "id", "mapping": {f"x{i}": i for i in range(n + 1)}, "default": 7}
        assert rows(projections.add_fields(spark.range(1), {"addFields": [config]})) == [(0, 7)]


def test_when_of_two_kinds_is_text(spark):
    config = {"name": "w", "function": "when", "condition": "id > 0", "then": 1, "otherwise": "adult"}
    assert rows(projections.add_fields(spark.range(2), {"addFields": [config]}), "w") == [("1",), ("adult",)]


def test_sha512(spark):
    config = {"name": "h", "function": "hash", "columns": ["a"], "algorithm": "sha512"}
    got = projections.add_fields(spark.createDataFrame([("abc",)], "a string"), {"addFields": [config]}).first()["h"]
    assert got.startswith("ddaf35a193617abacc417349ae204131") and got.endswith("2a9ac94fa54ca49f") and len(got) == 128


def test_partitioned_sinks_write_few_files(spark, tmp_path):
    data = spark.range(0, 1000, 1, 40).withColumn("p", F.col("id") % 5)
    write_sink(data, Sink("s", "s", (f"{tmp_path}/s",), "parquet", partition_by=("p",)))
    assert len(list((tmp_path / "s").glob("p=*/*.parquet"))) <= 5


def test_copies_of_a_sink_are_equal(spark, tmp_path):
    paths = (f"{tmp_path}/a", f"{tmp_path}/b")
    write_sink(spark.range(50).withColumn("r", F.rand()), Sink("s", "s", paths, "parquet"))
    assert rows(spark.read.parquet(paths[0])) == rows(spark.read.parquet(paths[1]))


def test_history_and_preflight(spark, tmp_path):
    audit = {"runs": f"{tmp_path}/runs", "logs": f"{tmp_path}/logs"}
    run(spark, {"s": spark.range(3)}, [], ["s"], tmp_path, audit=audit)
    assert [r["status"] for r in spark.read.parquet(audit["runs"]).collect()] == ["success"]
    flow = {"name": "t", "sources": [{"name": "s", "path": f"{tmp_path}/absent", "format": "JSON"}], "sinks": [{"input": "s", "name": "s", "paths": [f"{tmp_path}/x"]}], "settings": {"preflight": True, "audit": audit}}
    with pytest.raises(Exception, match="input folder not found"):
        CompiledFlow(spark, {"version": "1", "dataflows": [flow]}).run()
    assert sorted(r["status"] for r in spark.read.parquet(audit["runs"]).collect()) == ["failed", "success"]


def test_no_records_are_reported_without_rules(spark, tmp_path):
    step = {"name": "v", "type": "validate_fields", "params": {"input": "s", "validations": [{"field": "id", "validations": ["notNull"]}]}}
    report, _ = run(spark, {"s": spark.range(0)}, [step], ["validation_ok"], tmp_path)
    assert report.status == "success" and [g.message for g in report.gates] == ["No records processed"]
