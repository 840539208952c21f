"""What the plans must look like, so that they hold at any size."""

import pytest
from pyspark.sql import functions as F

from recordflow.operators import audit, relational, windows
from recordflow.operators.projections import add_fields
from recordflow.operators.quality import duplicates, reject_breakdown, summary
from recordflow.operators.validate import mark, split
from workload import QUERIES
from workload.registry import table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


ORDER_RULES = [
    {"field": "o_orderkey", "validations": ["notNull", {"type": "rangeCheck", "params": {"min": 1}}]},
    {"field": "o_orderstatus", "validations": ["notEmpty", {"type": "inList", "params": {"values": ["F"]}}]},
]


def test_split_has_no_shuffle_and_reads_only_what_it_needs(orders):
    parts = split(orders, ORDER_RULES)
    plan = plan_of(parts.valid.select("o_custkey"))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan
    assert "map_concat" not in plan


def test_error_map_stays_in_generated_code(orders):
    frame = split(orders, ORDER_RULES, details=True).rejected
    text = plan_of(frame)
    operators = [line for line in text.splitlines() if line.strip() and "FileScan" not in line]
    assert len(operators) >= 3 and all("*(1)" in line for line in operators)
    assert "lambda" not in text


def test_gate_counts_need_only_the_rule_columns(orders):
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan_of(summary(mark(orders, ORDER_RULES)))


def test_aggregates_combine_before_the_shuffle(orders):
    plan = plan_of(duplicates(orders, ["o_custkey"]))
    assert plan.index("functions=[partial_count(1)]") > plan.index("Exchange hashpartitioning")
    breakdown = plan_of(reject_breakdown(split(orders, ORDER_RULES).rejected))
    assert breakdown.count("Exchange") == 1 and "partial_count" in breakdown


def test_ordered_dedupe_keeps_one_row_per_key_and_task(orders):
    plan = plan_of(relational.deduplicate(orders, {"subset": ["o_custkey"], "orderBy": ["o_orderkey"]}))
    assert plan.count("Exchange") == 1
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:]


@pytest.mark.parametrize("columns", [["o_orderkey", "o_custkey"], ["o_custkey", "o_orderstatus"]])
def test_unordered_dedupe_never_aggregates_by_sorting(orders, columns):
    plan = plan_of(relational.deduplicate(orders.select(*columns), {"subset": ["o_custkey"]}))
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan
    assert ("WindowGroupLimit" in plan) == ("o_orderstatus" in columns)


def test_stage_detail_collects_by_part(spark, sf_dir):
    logs = table(spark, sf_dir, "logs")
    runs = logs.select("pipeline_id", F.array(F.expr("struct('x' AS name, 'ok' AS status, log_time AS start_time, log_time AS end_time)")).alias("stages"))
    plan = plan_of(audit.stage_detail(runs, logs))
    grouped = [line for line in plan.splitlines() if "collect_list" in line]
    assert grouped and all("part#" in line.split("functions=")[0] for line in grouped)


def test_common_windows_write_nothing(spark, sf_dir, monkeypatch):
    """Only a key that is hot has its rows staged."""
    from recordflow.operators import windows
    from recordflow.plans.staging import StagingArea

    monkeypatch.setattr(StagingArea, "stage", lambda *_: pytest.fail("staged"))
    windows.window(table(spark, sf_dir, "orders"), {"function": "rank", "partitionBy": ["o_custkey"], "orderBy": ["o_orderdate"], "alias": "r"}).count()


def test_listings_use_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(audit.list_runs(table(spark, sf_dir, "runs")))
    assert "TakeOrderedAndProject" in plan_of(audit.recent_errors(table(spark, sf_dir, "logs")))


def test_semi_join_moves_one_row_per_key(orders, spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    params = {"on": [{"left": "o_orderkey", "right": "l_orderkey"}], "how": "semi"}
    plan = plan_of(relational.join(orders, lines, params))
    assert "HashAggregate(keys=[l_orderkey" in plan


def test_window_is_one_shuffle(spark, sf_dir):
    params = {"partitionBy": ["user_id"], "orderBy": ["ts"], "function": "lag", "column": "value", "alias": "w"}
    assert plan_of(windows.window(table(spark, sf_dir, "events"), params)).count("Exchange") == 1


def test_fields_are_one_projection_over_the_scan(orders):
    fields = [
        {"name": "h", "function": "hash", "columns": ["o_orderkey"]},
        {"name": "s", "function": "when", "condition": "o_custkey > 5", "then": 1},
        {"name": "l", "function": "lookup", "column": "o_orderstatus", "mapping": {"F": 1, "O": 2}, "default": 0},
    ]
    plan = plan_of(add_fields(orders, {"addFields": fields}).select("h", "s", "l"))
    assert plan.count("Project") == 1 and plan.count("Exchange") == 0


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if not name.startswith(("src", "sink", "flow", "win_hot"))))
def test_no_query_runs_python_per_row_or_pairs_all_rows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
