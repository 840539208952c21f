import copy
import datetime
import glob
import json
import os
from collections import Counter

import pytest

from recordflow import CompiledFlow, FlowFailed, RuleRegistry, Spec, SpecError, run_flow
from recordflow.plans import flow as flows
from recordflow.plans.flow import FlowPlan
from recordflow.plans.staging import checkpoint_root
from tests.conftest import rows
from workload.validation import RULES

RUN_TIME = datetime.datetime(2025, 11, 19, 10, 21, 42, tzinfo=datetime.timezone.utc)
# A record of the golden rejects, its columns, and below the twenty faults that these have.
GOOD = {
    "policy_number": "POL123456", "driver_age": 40, "plate_number": "ABC-123", "premium": 1000.5,
    "vehicle_type": "sedan", "coverage_type": "collision", "policy_start_date": "2025-01-01",
    "policy_end_date": "2026-01-01", "driver_name": "Driver_1", "driver_license": "DL1234567",
}
SCHEMA = (
    "policy_number string, driver_age bigint, plate_number string, premium double, vehicle_type string, "
    "coverage_type string, policy_start_date string, policy_end_date string, driver_name string, driver_license string"
)


def rejects():
    """Twenty faulty records: 7 plates missing, 5 ages missing, 5 ages out of range, 3 numbers missing."""
    faults = [{"plate_number": ""}] * 4 + [{"plate_number": None}] * 3 + [{"driver_age": None}] * 5
    faults += [{"driver_age": age} for age in (15, 105, -5, 17, 101)] + [{"policy_number": ""}] * 3
    return [{**GOOD, "driver_name": f"Bad_{i}", **fault} for i, fault in enumerate(faults)]


def valid_records(count):
    return [{**GOOD, "policy_number": f"POL{i:06d}", "driver_age": 18 + i % 60} for i in range(count)]


def write_input(folder, records, name="policies.json"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(record) + "\n" for record in records))


def spec(tmp_path, **settings):
    priced = [
        {"name": "term_days", "function": "datediff", "start_date": "policy_start_date", "end_date": "policy_end_date"},
        {"name": "cover_code", "function": "substring", "column": "coverage_type", "start": 1, "length": 3},
        {"name": "token", "function": "uuid"},
        {"name": "seen", "function": "current_timestamp"},
    ]
    noted = [{"name": "noted_on", "function": "current_date"}, {"name": "noted", "function": "current_timestamp"}]
    return {
        "version": "1.0.0",
        "dataflows": [
            {
                "name": "policies",
                "sources": [{"name": "raw", "path": f"{tmp_path}/in/*", "format": "JSON", "options": {"multiLine": False}}],
                "transformations": [
                    {"name": "validation", "type": "validate_fields", "params": {"input": "raw", "validations": RULES}},
                    {"name": "ok", "type": "add_fields", "params": {"input": "validation_ok", "addFields": priced}},
                    {"name": "ko", "type": "add_fields", "params": {"input": "validation_ko", "addFields": noted}},
                    {"name": "unique", "type": "deduplicate", "params": {"input": "ok", "subset": ["policy_number"]}},
                ],
                "sinks": [
                    {"input": "ko", "name": "rejects", "paths": [f"{tmp_path}/rejects"], "format": "JSON",
                     "saveMode": "APPEND", "partitionBy": ["noted_on"]},
                    {"input": "unique", "name": "lines", "paths": [f"{tmp_path}/lines"], "format": "JSON", "saveMode": "APPEND"},
                    {"input": "unique", "name": "by_cover", "paths": [f"{tmp_path}/by_cover"], "format": "PARQUET",
                     "saveMode": "OVERWRITE", "partitionBy": ["coverage_type"]},
                ],
                "settings": settings,
            }
        ],
    }


@pytest.mark.parametrize("staging", ["auto", "never", "always"])
def test_whole_run(spark, tmp_path, staging):
    write_input(tmp_path / "in", valid_records(100) + rejects() + valid_records(2))
    document = spec(tmp_path, staging=staging, quality_rules={"min_valid_record_percentage": 80})
    before = copy.deepcopy(document)
    report = run_flow(spark, document, run_time=RUN_TIME)
    assert document == before
    assert report.status == "success"
    assert report.quality == [
        {"step": "validation", "total_records": 122, "valid_records": 102, "invalid_records": 20,
         "valid_percentage": pytest.approx(83.6065, abs=1e-3)}
    ]

    # Rejects: the messages, one key per row, NULL fields present, the date only in the folder name.
    path = f"{tmp_path}/rejects/noted_on=2025-11-19"
    lines = [json.loads(line) for file in glob.glob(f"{path}/*.json") for line in open(file)]
    assert Counter(message for line in lines for message in line["validation_errors"].values()) == {
        "plate_number cannot be empty": 7,
        "driver_age cannot be null": 5,
        "Driver age must be between 18 and 100": 5,
        "Policy number is required": 3,
    }
    assert all(len(line["validation_errors"]) == 1 and "noted_on" not in line for line in lines)
    assert all(set(GOOD) <= set(line) for line in lines)
    assert len({line["noted"] for line in lines}) == 1

    # Both sinks of the deduplicated rows hold the same values.
    lines = spark.read.json(f"{tmp_path}/lines")
    by_cover = spark.read.parquet(f"{tmp_path}/by_cover")
    assert by_cover.count() == 100
    names = ("policy_number", "term_days", "cover_code") + (("token",) if staging != "never" else ())
    assert rows(lines, *names) == rows(by_cover, *names)
    assert by_cover.select("seen", "term_days").distinct().collect()[0]["term_days"] == 365
    assert by_cover.select("seen").distinct().count() == 1
    assert os.path.isdir(f"{tmp_path}/by_cover/coverage_type=collision")

    counts = {item["name"]: item.get("record_count", item.get("input_counts")) for s in report.stages for item in s["data"]}
    assert counts == {
        "raw": 122, "validation": [122], "ok": [102], "ko": [20], "unique": [102],
        "rejects": 20, "lines": 100, "by_cover": 100,
    }
    assert [stage["status"] for stage in report.stages] == ["success"] * 3


def test_staged_tables_are_removed(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(3))
    flow = CompiledFlow(spark, spec(tmp_path))
    kept = flow.run(keep_staged=True)
    root = f"{checkpoint_root(spark)}/recordflow"
    assert sorted(name[4:] for name in os.listdir(f"{root}/{kept.pipeline_id}")) == ["unique", "validation"]
    gone = flow.run()
    assert not os.path.exists(f"{root}/{gone.pipeline_id}")


def test_rows_are_shuffled_for_partitions_that_differ_only(spark, tmp_path, monkeypatch):
    """The rejects go to the folder of the run's date, the others to folders by a column."""
    write_input(tmp_path / "in", valid_records(30) + rejects())
    asked, write = {}, flows.write_sink
    monkeypatch.setattr(flows, "write_sink", lambda df, sink, *a, **k: asked.update({sink.name: sink.rebalance}) or write(df, sink, *a, **k))
    document = spec(tmp_path, quality_rules={"min_valid_record_percentage": 20})
    assert run_flow(spark, document, run_time=RUN_TIME).status == "success"
    assert asked == {"rejects": False, "lines": None, "by_cover": None}
    assert spark.read.json(f"{tmp_path}/rejects").count() == 20

    steps = document["dataflows"][0]["transformations"]
    steps.append({"name": "kept", "type": "filter", "params": {"input": "ko", "condition": "premium > 0"}})
    changed = [{"name": "Noted_On", "function": "expr", "expression": "driver_age"}, {"name": "lot", "function": "literal", "value": 1}]
    steps.append({"name": "changed", "type": "add_fields", "params": {"input": "kept", "addFields": changed}})
    plan = FlowPlan(Spec.from_dict(document).dataflow())
    assert plan.constants(plan.names["kept"]) == {"noted_on", "noted"}
    assert plan.constants(plan.names["changed"]) == {"noted", "lot"}
    assert plan.constants(plan.names["unique"]) == plan.constants(plan.names["raw"]) == set()


def test_staged_rows_are_packed(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(3))
    kept = CompiledFlow(spark, spec(tmp_path)).run(keep_staged=True)
    files = glob.glob(f"{checkpoint_root(spark)}/recordflow/{kept.pipeline_id}/*/*.parquet")
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_json_of_the_shipments_is_packed(spark, sf_dir):
    """Whole rows, in a third of the bytes of their text at most."""
    from workload.files import run_shipments

    compiled, report = run_shipments(spark, sf_dir)
    counts = {item["name"]: item.get("record_count") for stage in report.stages for item in stage["data"]}
    places = {"lines": compiled.flow.sources[0].path, "feed": compiled.flow.sinks[1].paths[0], "returned": compiled.flow.sinks[3].paths[0]}
    for name, path in places.items():
        text = spark.read.text(path).selectExpr("count(value) AS n", "sum(length(value)) AS size").first()
        assert text["n"] == counts[name]
        assert sum(os.path.getsize(file) for file in glob.glob(f"{path}/**/part-*", recursive=True)) * 3 < text["size"], name


def test_the_shipments_are_shuffled_for_no_folder(spark, sf_dir, monkeypatch):
    """Seven years, and one day of rejects: each task writes a file per folder as the rows come."""
    from workload.files import run_shipments

    asked, write = {}, flows.write_sink
    monkeypatch.setattr(flows, "write_sink", lambda df, sink, *a, **k: asked.update({sink.name: sink.rebalance}) or write(df, sink, *a, **k))
    compiled, report = run_shipments(spark, sf_dir)
    assert asked == {"by-year": False, "feed": None, "totals": None, "returned": False}
    counts = {item["name"]: item.get("record_count") for item in report.stages[-1]["data"]}
    facts = spark.read.parquet(compiled.flow.sinks[0].paths[0])
    assert facts.count() == counts["by-year"] == counts["feed"]
    assert facts.filter("ship_year <> year(l_shipdate)").isEmpty()


def test_a_run_reads_in_small_splits_unless_told_otherwise(spark, tmp_path, monkeypatch):
    """A split of a packed staged table holds many rows, and a task sorts those in memory."""
    write_input(tmp_path / "in", valid_records(3))
    name, seen, write = "spark.sql.files.maxPartitionBytes", set(), flows.write_sink
    monkeypatch.setattr(flows, "write_sink", lambda df, *a, **k: seen.add(spark.conf.get(name)) or write(df, *a, **k))
    assert spark.conf.get(name, None) is None
    assert run_flow(spark, spec(tmp_path)).status == "success"
    assert seen == {"32m"} and spark.conf.get(name, None) is None
    spark.conf.set(name, "1m")
    try:
        assert run_flow(spark, spec(tmp_path)).status == "success"
        assert seen == {"32m", "1m"} and spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_gate_stops_a_run_before_any_write(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(30) + rejects())
    document = spec(tmp_path, quality_rules={"min_valid_record_percentage": 80})
    with pytest.raises(FlowFailed, match="60.00% valid records") as failure:
        run_flow(spark, document)
    report = failure.value.report
    assert report.status == "failed"
    assert [gate.passed for gate in report.gates] == [False]
    assert [stage["status"] for stage in report.stages] == ["success", "failed"]
    assert os.listdir(tmp_path) == ["in"]


def test_no_rules_no_gate_and_default_minimum(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(30) + rejects())
    assert run_flow(spark, spec(tmp_path)).gates == []
    with pytest.raises(FlowFailed, match="minimum: 80"):
        run_flow(spark, spec(tmp_path, quality_rules={"max_duplicate_percentage": 5}))


def test_duplicate_gate(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(10) * 2)
    with pytest.raises(FlowFailed, match="50.00% duplicate records"):
        run_flow(spark, spec(tmp_path, quality_rules={"max_duplicate_percentage": 49}))
    report = run_flow(spark, spec(tmp_path, quality_rules={"max_duplicate_percentage": 50}))
    assert [(gate.name, gate.passed) for gate in report.gates] == [
        ("min_valid_record_percentage", True),
        ("max_duplicate_percentage", True),
    ]


def test_no_records_fail_the_gate(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    flow = CompiledFlow(spark, spec(tmp_path, quality_rules={"x": 1}), inputs={"raw": empty})
    with pytest.raises(FlowFailed, match="No records processed"):
        flow.run()


def test_a_failing_run_reports_its_error_and_stage(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(3))
    (tmp_path / "by_cover").mkdir()
    (tmp_path / "by_cover" / "x").write_text("x")
    document = spec(tmp_path)
    document["dataflows"][0]["sinks"][2]["saveMode"] = "ERROR"
    with pytest.raises(FlowFailed) as failure:
        run_flow(spark, document)
    assert failure.value.report.error_message
    assert [stage["status"] for stage in failure.value.report.stages] == ["success", "success", "failed"]


def test_output_names_do_not_matter_for_the_counts(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(8) + rejects()[:2])
    document = spec(tmp_path)
    flow = document["dataflows"][0]
    flow["transformations"][0]["params"] |= {"valid_output": "good", "invalid_output": "bad"}
    flow["transformations"][1]["params"]["input"] = "good"
    flow["transformations"][2]["params"]["input"] = "bad"
    measured = run_flow(spark, document).quality[0]
    assert (measured["valid_records"], measured["invalid_records"]) == (8, 2)


def test_every_dataflow_can_be_run(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(3))
    document = spec(tmp_path)
    second = copy.deepcopy(document["dataflows"][0])
    second["name"] = "other"
    second["sinks"] = [{"input": "raw", "name": "k", "paths": [f"{tmp_path}/raw"], "format": "CSV"}]
    document["dataflows"].append(second)
    report = run_flow(spark, document, dataflow="other")
    assert report.metadata_name == "other"
    assert sorted(os.listdir(tmp_path)) == ["in", "raw"]


def test_a_later_name_hides_an_earlier_one(spark, tmp_path):
    data = spark.createDataFrame([(1,), (5,), (9,)], "n int")
    steps = [
        {"name": "s", "type": "filter", "params": {"input": "s", "condition": "n > 1"}},
        {"name": "s", "type": "filter", "params": {"input": "s", "condition": "n < 9"}},
    ]
    sinks = [{"input": "s", "name": "k", "paths": [f"{tmp_path}/o"], "format": "PARQUET"}]
    document = {"dataflows": [{"sources": [{"name": "s", "path": "-"}], "transformations": steps, "sinks": sinks}]}
    run_flow(spark, document, inputs={"s": data})
    assert rows(spark.read.parquet(f"{tmp_path}/o")) == [(5,)]


def test_all_step_types_in_one_flow(spark, tmp_path):
    orders = spark.createDataFrame(
        [(1, "a", 10.0, "x"), (2, "a", 20.0, "y"), (3, "b", 30.0, "x"), (3, "b", 30.0, "x")],
        "id int, who string, amount double, kind string",
    )
    people = spark.createDataFrame([("a", "Ann"), ("b", "Bob"), ("c", "Cy")], "who string, name string")
    steps = [
        ("dedup", "deduplicate", {"input": "orders"}),
        ("joined", "join", {"input": "dedup", "right": "people", "on": ["who"], "how": "left"}),
        ("both", "union", {"inputs": ["joined", "joined"], "distinct": True}),
        ("renamed", "rename_columns", {"input": "both", "mapping": {"amount": "price"}}),
        ("dropped", "drop_columns", {"input": "renamed", "columns": ["who"]}),
        ("ranked", "window", {"input": "dropped", "partitionBy": ["name"], "orderBy": ["id"], "function": "lag",
                              "column": "price", "alias": "before"}),
        ("totals", "aggregate", {"input": "ranked", "groupBy": ["name", "kind"],
                                 "aggregations": [{"function": "sum", "column": "price", "alias": "total"}]}),
        ("wide", "pivot", {"input": "totals", "groupBy": ["name"], "pivotColumn": "kind", "valueColumn": "total"}),
    ]
    document = {
        "dataflows": [
            {
                "sources": [{"name": "orders", "path": "-"}, {"name": "people", "path": "-"}],
                "transformations": [{"name": n, "type": t, "params": p} for n, t, p in steps],
                "sinks": [
                    {"input": "wide", "name": "k", "paths": [f"{tmp_path}/o"], "format": "PARQUET"},
                    {"input": "ranked", "name": "r", "paths": [f"{tmp_path}/r"], "format": "PARQUET"},
                ],
            }
        ]
    }
    report = run_flow(spark, document, inputs={"orders": orders, "people": people})
    assert rows(spark.read.parquet(f"{tmp_path}/o"), "name", "x", "y") == [("Ann", 10.0, 20.0), ("Bob", 30.0, None)]
    assert rows(spark.read.parquet(f"{tmp_path}/r"), "id", "before") == [(1, None), (2, 10.0), (3, None)]
    counts = {item["name"]: item["input_counts"] for item in report.stages[1]["data"]}
    assert counts["joined"] == [3, 3] and counts["both"] == [3, 3] and counts["wide"] == [3]


def test_problems_are_found_before_any_job(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(3))
    for change in (
        lambda flow: flow["transformations"][0]["params"]["validations"].append({"field": "policy_number", "validations": ["odd"]}),
        lambda flow: flow["transformations"][1]["params"]["addFields"].append({"name": "x", "function": "odd"}),
        lambda flow: flow["sinks"][0].update(partitionBy=["nope"]),
    ):
        document = spec(tmp_path)
        document["dataflows"][0]["sources"][0]["schema"] = SCHEMA
        document["dataflows"][0]["transformations"][0]["params"]["validations"] = list(RULES)
        change(document["dataflows"][0])
        with pytest.raises(SpecError):
            CompiledFlow(spark, document).check()
        with pytest.raises(FlowFailed):
            run_flow(spark, document)
    assert os.listdir(tmp_path) == ["in"]


def test_own_rules_reach_the_flow(spark, tmp_path):
    from pyspark.sql import functions as F

    rules = RuleRegistry()
    rules.register("never", lambda df, field, params: F.lit("no"))
    document = spec(tmp_path)
    document["dataflows"][0]["transformations"][0]["params"]["validations"] = [{"field": "premium", "validations": ["never"]}]
    data = spark.createDataFrame([GOOD], SCHEMA)
    frames = CompiledFlow(spark, document, rules=rules, inputs={"raw": data}).frames
    assert (frames["validation_ok"].count(), frames["validation_ko"].count()) == (0, 1)


def test_unread_steps_are_not_computed(spark, tmp_path):
    """A step that no sink reads cannot fail a run, nor hold up its counts."""
    data = spark.createDataFrame([(1, "x")], "n int, t string")
    steps = [{"name": "boom", "type": "filter", "params": {"input": "s", "condition": "raise_error(t) IS NULL"}}]
    sinks = [{"input": "s", "name": "k", "paths": [f"{tmp_path}/o"], "format": "PARQUET"}]
    document = {"dataflows": [{"sources": [{"name": "s", "path": "-"}], "transformations": steps, "sinks": sinks}]}
    assert run_flow(spark, document, inputs={"s": data}).status == "success"


def test_filter_on_a_source_reaches_the_scan(spark, tmp_path):
    """A source that a filter reads is not counted on the way, so partitions can be pruned; its footers tell its rows."""
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{tmp_path}/in")
    document = {
        "dataflows": [
            {
                "sources": [{"name": "s", "path": f"{tmp_path}/in", "format": "parquet"}],
                "transformations": [{"name": "t", "type": "filter", "params": {"input": "s", "condition": "p = 1"}}],
                "sinks": [{"input": "t", "name": "k", "paths": [f"{tmp_path}/o"], "format": "PARQUET"}],
            }
        ]
    }
    report = run_flow(spark, document)
    assert report.stages[0]["data"] == [{"name": "s", "record_count": 10}]
    assert report.stages[2]["data"][0]["record_count"] == 5


def test_report_and_audit_rows(spark, tmp_path):
    write_input(tmp_path / "in", valid_records(9) + rejects()[:1])
    report = run_flow(spark, spec(tmp_path, quality_rules={"min_valid_record_percentage": 50}))
    report.write(spark, f"{tmp_path}/report")
    written = spark.read.json(f"{tmp_path}/report").first()
    assert (written["status"], written["metadata_name"]) == ("success", "policies")
    for _ in range(2):
        report.append_audit(spark, f"{tmp_path}/runs", f"{tmp_path}/logs")
    run = spark.read.parquet(f"{tmp_path}/runs").first()
    assert (run["total_records"], run["valid_records"], run["invalid_records"]) == (10, 9, 1)
    assert [stage["name"] for stage in run["stages"]] == ["ingestion", "transformation", "storage"]
    logs = spark.read.parquet(f"{tmp_path}/logs")
    assert logs.count() == 2 * 5
    assert logs.filter("level <> 'INFO'").count() == 0


def test_command_line_spec_parses():
    assert Spec.from_json(json.dumps(spec("/x"))).dataflow().sinks[2].partition_by == ("coverage_type",)


def staged(steps, sinks, format="JSON", **settings):
    """Names of the nodes a run would stage."""
    document = {
        "dataflows": [
            {
                "sources": [{"name": "s", "path": "-", "format": format}, {"name": "r", "path": "-", "format": format}],
                "transformations": [{"name": n, "type": t, "params": p} for n, t, p in steps],
                "sinks": [{"input": i, "name": f"k{n}", "paths": ["o"], "format": "CSV"} for n, i in enumerate(sinks)],
                "settings": settings,
            }
        ]
    }
    plan = FlowPlan(Spec.from_dict(document).dataflow())
    return [node.name for node in plan.nodes if plan.is_staged(node.position)]


def test_what_is_staged():
    rules = ("v", "validate_fields", {"input": "s", "validations": []})
    named = ("n", "add_fields", {"input": "s", "addFields": [{"name": "x", "function": "uuid"}]})
    totals = ("a", "aggregate", {"input": "s", "groupBy": ["k"], "aggregations": [{"function": "count", "column": "*"}]})
    window = {"partitionBy": ["k"], "orderBy": ["o"], "function": "rank", "alias": "w"}
    # A validation over text files, random values or a shuffle, but not over plain Parquet.
    assert staged([rules], ["validation_ok"]) == ["v"]
    assert staged([rules], ["validation_ok"], "PARQUET") == []
    assert staged([rules], ["validation_ok"], "PARQUET", staging="always") == ["v"]
    assert staged([rules], ["validation_ok"], staging="never") == []
    assert staged([named, ("v", "validate_fields", {"input": "n"})], ["validation_ok"], "PARQUET") == ["v"]
    assert staged([totals, ("v", "validate_fields", {"input": "a"})], ["validation_ok"], "PARQUET") == ["v"]
    # A step that no sink depends on is no reader.
    assert staged([totals, ("x", "filter", {"input": "a", "condition": "true"})], ["a"]) == []
    # A step with two readers, and one whose reader looks at it twice.
    assert staged([totals], ["a"]) == []
    assert staged([totals], ["a", "a"]) == ["a"]
    assert staged([totals, ("w", "window", {"input": "a", **window})], ["w"]) == ["a"]
    assert staged([rules, ("w", "window", {"input": "validation_ok", **window})], ["w"]) == ["v"]
    dedupe = ("d", "deduplicate", {"input": "a"})
    assert staged([totals, dedupe], ["d"]) == []
    assert staged([totals, dedupe], ["d"], quality_rules={"max_duplicate_percentage": 5}) == ["a"]
    join = {"input": "r", "right": "a", "on": ["k"]}
    assert staged([totals, ("j", "join", {**join, "how": "left"})], ["j"]) == ["a"]
    assert staged([totals, ("j", "join", join)], ["j"]) == []
    chain = [(f"c{n}", "filter", {"input": f"c{n - 1}" if n else "s", "condition": "true"}) for n in range(200)]
    assert staged([*chain, ("v", "validate_fields", {"input": "c199"})], ["validation_ok"], "PARQUET") == []
