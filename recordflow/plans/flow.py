"""A dataflow compiled into lazy frames, and a run of it.

A run makes one pass over a row-format source: the marked rows are staged, the gates are
decided from the staged table's flag column, and only then are sinks written. Row counts come from what is
committed: gates, footers of staged tables and columnar sources, and written sinks, also across steps that keep every row. Only where none of
these tells, a count is observed on the way, and trusted if no task of the run had to run again.
"""

from __future__ import annotations

import datetime
import logging
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordflow.errors import FlowFailed
from recordflow.functions.fields import FieldRegistry
from recordflow.functions.rules import RuleRegistry
from recordflow.operators import quality
from recordflow.operators.relational import MAX_PIVOT_VALUES, RANGES, pivot_values
from recordflow.operators.steps import apply_step
from recordflow.operators.validate import accepted, judged, mark, rejected
from recordflow.plans.report import RunReport
from recordflow.plans.session import tuned
from recordflow.plans.spec import ROW_WISE_STEPS, Dataflow, Sink, Source, Spec, Step
from recordflow.plans.staging import StagingArea, is_repeatable
from recordflow.sinks.writers import check_sink_columns, write_sink
from recordflow.sources.readers import read_source, require_input

log = logging.getLogger(__name__)

# Steps that give one row for each of their input.
ROW_KEEPING_STEPS = ("add_fields", "rename_columns", "drop_columns", "select_columns", "window")

# Fields that have one value in all rows of a run.
CONSTANT_FIELDS = ("literal", "current_date", "current_timestamp")
# Whole rows are staged, random ids among them, which the session's usual codec leaves as long as they are.
STAGED_CODEC = "zstd"

HOT_KEYS, DUPLICATES, PIVOT_VALUES, LEVELS = "hot keys", "duplicates", "pivot values", "levels of a range join"


@dataclass
class Node:
    """One frame of a dataflow: a source, a step, or an marked, valid or rejected table."""

    position: int
    kind: str
    name: str
    parents: tuple[int, ...] = ()
    source: Source | None = None
    step: Step | None = None
    readers: list[str] = field(default_factory=list)
    # Readers that come on top: checks for duplicates and hot keys, and the look-up of pivot values.
    checks: list[str] = field(default_factory=list)


class FlowPlan:
    """Names resolved to nodes, in the order of the spec. A later name hides an earlier one."""

    def __init__(self, flow: Dataflow):
        self.flow = flow
        self.nodes: list[Node] = []
        self.names: dict[str, int] = {}
        self._cheap: dict[int, bool] = {}
        for source in flow.sources:
            self.names[source.name] = self._add("source", source.name, source=source)
        for step in flow.steps:
            parents = tuple(self.names[name] for name in step.inputs)
            if step.type == "validate_fields":
                marked = self._add("marked", step.name, parents, step=step)
                for kind, output in zip(("valid", "rejected"), step.outputs):
                    self.names[output] = self._add(kind, output, (marked,), step=step)
            else:
                self.names[step.name] = self._add("step", step.name, parents, step=step)
        self.sink_nodes = [self.names[sink.input] for sink in flow.sinks]
        self.needed = self._needed()
        self._find_readers()

    def _add(self, kind, name, parents=(), source=None, step=None) -> int:
        self.nodes.append(Node(len(self.nodes), kind, name, parents, source, step))
        return len(self.nodes) - 1

    def _find_readers(self) -> None:
        """Who reads each node in a run; steps that no sink depends on read nothing."""
        for node in (self.nodes[position] for position in sorted(self.needed)):
            for parent in node.parents:
                self.nodes[parent].readers.append(node.step.type)
            if node.kind in ("step", "marked"):
                for parent, check in self._checks(node.step, node.parents):
                    self.nodes[parent].checks.append(check)
            if node.kind == "marked":
                node.readers.append("gate")
        for position, sink in zip(self.sink_nodes, self.flow.sinks):
            self.nodes[position].readers.extend("sink" for _ in sink.paths)

    def _checks(self, step: Step, parents: tuple[int, ...]) -> list[tuple[int, str]]:
        if step.type == "window":
            return [(parents[0], HOT_KEYS)]
        if step.type == "pivot" and not step.params.get("values"):
            return [(parents[0], PIVOT_VALUES)]
        if step.type == "deduplicate" and "max_duplicate_percentage" in self.flow.settings.quality_rules:
            return [(parents[0], DUPLICATES)]
        if step.type == "join" and any(step.params.get(name) for name in RANGES):
            return [(parent, LEVELS) for parent in parents]
        how = step.params.get("how") if step.type == "join" else None
        checked = {"left": parents[1:], "right": parents[:1], "full": parents}.get(how, ())
        return [(parent, HOT_KEYS) for parent in checked]

    def _needed(self) -> set[int]:
        """Nodes that some sink depends on, and all validations."""
        wanted, pending = set(), [*self.sink_nodes, *(n.position for n in self.nodes if n.kind == "marked")]
        while pending:
            position = pending.pop()
            if position not in wanted:
                wanted.add(position)
                pending.extend(self.nodes[position].parents)
        return wanted

    def rescan_is_cheap(self, position: int) -> bool:
        """Whether a node is only row-wise, repeatable work over columnar files or staged tables."""
        if position not in self._cheap:
            node = self.nodes[position]
            if node.source is not None:
                cheap = node.source.format == "parquet"
            elif node.step.type not in ROW_WISE_STEPS or _makes_random_values(node.step):
                cheap = False
            else:
                cheap = all(self.is_staged(parent) or self.rescan_is_cheap(parent) for parent in node.parents)
            self._cheap[position] = cheap
        return self._cheap[position]

    def constants(self, position: int) -> set[str]:
        """Columns, in lower case, that an ``add_fields`` gives one value in all rows of this node."""
        node = self.nodes[position]
        if node.kind != "step" or node.step.type not in ("add_fields", "drop_columns", "select_columns", "filter"):
            return set()
        found = self.constants(node.parents[0])
        # Later fields of a step replace earlier ones of their name.
        for config in (node.step.params.get("addFields") or []) if node.step.type == "add_fields" else []:
            name = config["name"].lower()
            found = found | {name} if config.get("function") in CONSTANT_FIELDS else found - {name}
        return found

    def is_staged(self, position: int) -> bool:
        """Whether a run writes this node once instead of computing it for every reader."""
        node, mode = self.nodes[position], self.flow.settings.staging
        if mode == "never" or node.kind in ("valid", "rejected"):
            return False
        if node.kind == "source":
            return len(node.readers) >= 2 and (mode == "always" or node.source.format != "parquet")
        if len(node.readers) >= 2 and (mode == "always" or node.kind == "step"):
            return True
        return len(node.readers) + len(node.checks) >= 2 and not self.rescan_is_cheap(position)

    def is_read_twice(self, position: int) -> bool:
        """Whether a node that gives other values when it is computed again must be staged."""
        node = self.nodes[position]
        if self.flow.settings.staging == "never" or node.kind in ("valid", "rejected"):
            return False
        return len(node.readers) + len(node.checks) >= 2


class CompiledFlow:
    """A dataflow bound to a session; ``frames`` holds one lazy frame per name."""

    def __init__(
        self,
        spark: SparkSession,
        spec: Spec | Mapping[str, Any],
        dataflow: str | None = None,
        rules: RuleRegistry | None = None,
        fields: FieldRegistry | None = None,
        run_time: datetime.datetime | None = None,
        inputs: Mapping[str, DataFrame] | None = None,
    ):
        """``inputs`` gives frames for sources by name, in place of reading their paths."""
        spec = spec if isinstance(spec, Spec) else Spec.from_dict(spec)
        self.spark = spark
        self.spec_version = spec.version
        self.flow = spec.dataflow(dataflow)
        self.rules = rules or RuleRegistry()
        self.fields = fields or FieldRegistry()
        self.run_time = run_time or datetime.datetime.now(datetime.timezone.utc)
        self.inputs = dict(inputs or {})
        self.plan = FlowPlan(self.flow)
        # Kept between the check and the execution of a run, so that schema inference is not done twice.
        self._source_frames: dict[int, DataFrame] = {}

    @cached_property
    def frames(self) -> dict[str, DataFrame]:
        """Lazy frames by name, not counted; only a window over a hot key stages rows."""
        return self._lazy(StagingArea(self.spark))

    def check(self) -> None:
        """Raise for anything that can be found without reading rows."""
        frames = self._lazy(None)
        for sink in self.flow.sinks:
            if frames[sink.input] is not None:
                check_sink_columns(frames[sink.input], sink)

    def run(self, run_id: str | None = None, keep_staged: bool = False) -> RunReport:
        """Write all sinks, after all gates have passed.

        Raises FlowFailed, which carries the report, when the run stops.
        """
        report = RunReport.start(run_id or f"direct_{uuid.uuid4().hex}", self.flow, self.spec_version)
        area = StagingArea(self.spark, report.pipeline_id, STAGED_CODEC)
        self._source_frames.clear()
        try:
            with tuned(self.spark), area.watched():
                if self.flow.settings.preflight:
                    self._require_inputs()
                self.check()
                _Run(self, area, report).execute()
            report.finish("success")
        except Exception as error:
            report.finish("failed", str(error))
            raise FlowFailed(f"run {report.pipeline_id} failed: {error}", report) from error
        finally:
            if not keep_staged:
                area.discard()
            self._append_audit(report)
        return report

    def _require_inputs(self) -> None:
        for source in self.flow.sources:
            if source.name not in self.inputs:
                require_input(self.spark, source.path, "*")

    def _append_audit(self, report: RunReport) -> None:
        """Add the run to the history; what is written already does not fail for want of it."""
        paths = self.flow.settings.audit
        if paths:
            try:
                report.append_audit(self.spark, paths["runs"], paths["logs"])
            except Exception:
                log.exception("run %s is missing in the history", report.pipeline_id)

    def _lazy(self, area: StagingArea | None) -> dict[str, DataFrame]:
        """Without an area no job is started; what comes after a pivot without values is None then."""
        built: dict[int, DataFrame | None] = {}
        for node in self.plan.nodes:
            parents = [built[p] for p in node.parents]
            unknown = any(parent is None for parent in parents) or area is None and PIVOT_VALUES in self._looks_up(node)
            built[node.position] = None if unknown else self._frame(node, parents, area)
        return {name: built[position] for name, position in self.plan.names.items()}

    def _looks_up(self, node: Node) -> list[str]:
        return [check for _, check in self.plan._checks(node.step, node.parents)] if node.kind == "step" else []

    def _frame(self, node: Node, parents: list[DataFrame], area: StagingArea | None) -> DataFrame:
        if node.kind == "source":
            if node.name in self.inputs:
                return self.inputs[node.name]
            if node.position not in self._source_frames:
                self._source_frames[node.position] = read_source(self.spark, node.source)
            return self._source_frames[node.position]
        if node.kind == "valid":
            return accepted(parents[0])
        if node.kind in ("marked", "rejected"):
            params = node.step.params
            entries = params.get("validations") or []
            if node.kind == "marked":
                marked = mark(parents[0], entries, self.rules)
                if is_repeatable(marked):
                    return marked
                # Rules that answer differently next time are asked once: the messages come along.
                return judged(parents[0], entries, self.rules, bool(params.get("details", False)))
            return rejected(parents[0], entries, self.rules, bool(params.get("details", False)))
        step = node.step
        if PIVOT_VALUES in self._looks_up(node):
            # From the frame that is pivoted, which a run has staged by now.
            limit = step.params.get("maxValues", MAX_PIVOT_VALUES)
            step = replace(step, params={**step.params, "values": pivot_values(parents[0], step.params["pivotColumn"], limit)})
        return apply_step(step, parents, self.fields, self.run_time, area)


class _Run:
    """One execution: stages shared frames, decides gates, writes sinks, collects counts."""

    def __init__(self, compiled: CompiledFlow, area: StagingArea, report: RunReport):
        self.compiled = compiled
        self.plan = compiled.plan
        self.flow = compiled.flow
        self.area = area
        self.report = report
        self.frames: dict[int, DataFrame] = {}
        self.observations: dict[int, Observation] = {}
        # Counts that no task can have added twice, and frames whose files know their number of rows.
        self.counts: dict[int, int] = {}
        self.footers: dict[int, DataFrame] = {}
        # Row-wise work over columnar files, which is cheap to count.
        self.cheap: dict[int, DataFrame] = {}

    def execute(self) -> None:
        report, plan = self.report, self.plan
        nodes = [node for node in plan.nodes if node.position in plan.needed]
        with report.stage("ingestion") as ingestion:
            self._build(node for node in nodes if node.kind == "source")
        with report.stage("transformation") as transformation:
            self._build(node for node in nodes if node.kind != "source")
        with report.stage("storage") as storage:
            for sink, position in zip(self.flow.sinks, plan.sink_nodes):
                storage.append(self._write(sink, position))
        for node in nodes:
            if node.kind == "source":
                ingestion.append({"name": node.name, "record_count": self._count(node.position)})
            elif node.kind in ("step", "marked"):
                inputs = [self._count(parent) for parent in node.parents]
                transformation.append({"name": node.name, "type": node.step.type, "input_counts": inputs})

    def _build(self, nodes) -> None:
        for node in nodes:
            parents = [self.frames[position] for position in node.parents]
            df = self.compiled._frame(node, parents, self.area)
            if node.kind == "step" and node.step.type == "deduplicate":
                self._gate_duplicates(node, parents[0])
            if node.kind == "source" and node.source.format == "parquet" and node.name not in self.compiled.inputs:
                self.footers[node.position] = df
            elif node.kind in ("source", "step") and "filter" not in node.readers:
                # A count between a scan and a filter would keep the filter from reaching the scan.
                df = self._observed(node.position, df)
            if self._is_worth_staging(node, df):
                df = self.area.stage(df, node.name)
                self.footers[node.position] = self.cheap[node.position] = df
            elif node.kind in ("source", "step") and self.plan.rescan_is_cheap(node.position):
                self.cheap[node.position] = df
            if node.kind == "marked":
                self._gate_validity(node, df)
            self.frames[node.position] = df

    def _is_worth_staging(self, node: Node, df: DataFrame) -> bool:
        if self.plan.is_staged(node.position):
            return True
        return self.plan.is_read_twice(node.position) and not is_repeatable(df)

    def _observed(self, position: int, df: DataFrame) -> DataFrame:
        observation = Observation(f"{self.report.pipeline_id}_{position}")
        self.observations[position] = observation
        return df.observe(observation, F.count(F.lit(1)).alias("n"))

    def _count(self, position: int) -> int | None:
        """The rows of a node, None if nothing tells.

        An observed count can hold rows of a task twice that ran again, so it is only taken from a run without such
        tasks. Adaptive execution leaves an observation out with a branch that it finds no use for. Then the node is counted
        if that is cheap or, after tasks that ran again, if it gives the same rows once more.
        """
        n = self._committed(position, set())
        if n is None and position in self.observations and not self.area.has_rerun_tasks():
            n = observed(self.observations[position])
        if n is None and position in self.observations:
            frame = self.cheap.get(position)
            if frame is None and self.area.has_rerun_tasks() and is_repeatable(self.frames[position]):
                frame = self.frames[position]
            n = self._counted(frame)
        return n

    def _committed(self, position: int, asked: set[int]) -> int | None:
        """The rows of a node by gates, files and sinks, or by those of a neighbour that has as many."""
        if position in self.counts or position in asked:
            return self.counts.get(position)
        asked.add(position)
        n = self._counted(self.footers.get(position))
        if n is None:
            node = self.plan.nodes[position]
            if node.kind == "step" and node.step.type == "union" and not node.step.params.get("distinct"):
                parts = [self._committed(parent, asked) for parent in node.parents]
                n = sum(parts) if None not in parts else None
            equals = list(node.parents) if _keeps_rows(node) else []
            equals += [x.position for x in self.plan.nodes if x.position in self.plan.needed and _keeps_rows(x) and position in x.parents]
            for other in equals:
                n = self._committed(other, asked) if n is None else n
        if n is not None:
            self.counts[position] = n
        return n

    def _counted(self, df: DataFrame | None) -> int | None:
        try:
            return None if df is None else df.count()
        except Exception:  # the sinks are written: a count must not fail the run
            log.warning("a table could not be counted", exc_info=True)
            return None

    def _gate_validity(self, node: Node, marked: DataFrame) -> None:
        """Count valid rows, from the flag column alone when the table is staged, and decide."""
        measured = quality.summary(marked).first().asDict()
        self.report.add_quality(node.name, measured)
        self.counts[node.position] = measured["total_records"]
        rules = self.flow.settings.quality_rules
        for output in self.plan.nodes[node.position + 1 : node.position + 3]:
            self.counts[output.position] = measured[f"{'valid' if output.kind == 'valid' else 'invalid'}_records"]
        if rules:
            minimum = rules.get("min_valid_record_percentage", quality.DEFAULT_MIN_VALID_PERCENTAGE)
            self._decide(quality.min_valid_gate(measured, minimum))
        elif not measured["total_records"]:
            # Told in the report, although no rule makes it a failure.
            self.report.gates.append(quality.min_valid_gate(measured, 0))

    def _gate_duplicates(self, node: Node, df: DataFrame) -> None:
        maximum = self.flow.settings.quality_rules.get("max_duplicate_percentage")
        if maximum is not None:
            measured = quality.duplicates(df, node.step.params.get("subset") or ()).first().asDict()
            self.counts[node.parents[0]] = measured["total_records"]
            self._decide(quality.max_duplicate_gate(measured, maximum))

    def _decide(self, gate: quality.Gate) -> None:
        self.report.gates.append(gate)
        quality.require([gate])

    def _write(self, sink: Sink, position: int) -> dict[str, Any]:
        observation = Observation(f"{self.report.pipeline_id}_{sink.name}")
        started = time.monotonic()
        if sink.partition_by and sink.rebalance is None and {name.lower() for name in sink.partition_by} <= self.plan.constants(position):
            # One folder takes all rows, and each task one file in it, as without partitions.
            sink = replace(sink, rebalance=False)
        write_sink(self.frames[position], sink, observation, stable=position in self.cheap)
        log.info("sink %s written in %.1f s", sink.name, time.monotonic() - started)
        written = observed(observation)
        if written is not None and len(sink.paths) == 1:
            # Counted in the last stage, where each partition's count is taken once.
            self.counts.setdefault(position, written)
        return {
            "name": sink.name,
            "input": sink.input,
            "success": True,
            # A sink whose rows all fell away before its observation has none.
            "record_count": written or 0,
            "paths": list(sink.paths),
        }


def observed(observation: Observation) -> int | None:
    """The counted rows, or None if execution has left the observation out."""
    try:
        return observation.get.get("n")
    except Exception:  # an observation that never ran has no value, and says so in several ways
        return None


def compile_flow(spark: SparkSession, spec: Spec | Mapping[str, Any], **options) -> CompiledFlow:
    return CompiledFlow(spark, spec, **options)


def run_flow(spark: SparkSession, spec: Spec | Mapping[str, Any], **options) -> RunReport:
    return CompiledFlow(spark, spec, **options).run()


def _keeps_rows(node: Node) -> bool:
    """Whether a node has one row for each of its parent's."""
    return node.kind == "marked" or node.kind == "step" and node.step.type in ROW_KEEPING_STEPS


def _makes_random_values(step: Step) -> bool:
    return any(config.get("function") == "uuid" for config in step.params.get("addFields") or [])
