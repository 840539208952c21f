"""The spec document as frozen dataclasses, with the checks that need no data."""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from recordflow.errors import SpecError

# Fixed values of the spec format.
FORMATS = ("json", "csv", "parquet", "avro")
SAVE_MODES = ("error", "append", "overwrite", "ignore")
STEP_TYPES = (
    "validate_fields",
    "add_fields",
    "rename_columns",
    "drop_columns",
    "select_columns",
    "filter",
    "deduplicate",
    "join",
    "union",
    "aggregate",
    "pivot",
    "window",
)
DEFAULT_VALID_OUTPUT = "validation_ok"
DEFAULT_INVALID_OUTPUT = "validation_ko"

# Steps that look at one row at a time and so never shuffle.
ROW_WISE_STEPS = (
    "validate_fields",
    "add_fields",
    "rename_columns",
    "drop_columns",
    "select_columns",
    "filter",
)


@dataclass(frozen=True)
class Source:
    name: str
    path: Any
    format: str = "json"
    options: Mapping[str, Any] = field(default_factory=dict)
    schema: str | None = None


@dataclass(frozen=True)
class Step:
    name: str
    type: str
    params: Mapping[str, Any]

    @property
    def inputs(self) -> tuple[str, ...]:
        if self.type == "union":
            return tuple(self.params.get("inputs") or ())
        if self.type == "join":
            return (self.params.get("input"), self.params.get("right"))
        return (self.params.get("input"),)

    @property
    def outputs(self) -> tuple[str, ...]:
        if self.type == "validate_fields":
            return (
                self.params.get("valid_output", DEFAULT_VALID_OUTPUT),
                self.params.get("invalid_output", DEFAULT_INVALID_OUTPUT),
            )
        return (self.name,)


@dataclass(frozen=True)
class Sink:
    name: str
    input: str
    paths: tuple[str, ...]
    format: str = "json"
    mode: str = "error"
    partition_by: tuple[str, ...] = ()
    options: Mapping[str, Any] = field(default_factory=dict)
    overwrite_partitions: bool = False
    # None: where the sink is partitioned.
    rebalance: bool | None = None


@dataclass(frozen=True)
class Settings:
    spark: Mapping[str, Any] = field(default_factory=dict)
    quality_rules: Mapping[str, Any] = field(default_factory=dict)
    staging: str = "auto"
    # Whether file sources must hold files before anything else is done.
    preflight: bool = False
    # Where runs append their history: paths of the tables ``runs`` and ``logs``.
    audit: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Dataflow:
    name: str
    sources: tuple[Source, ...]
    steps: tuple[Step, ...]
    sinks: tuple[Sink, ...]
    settings: Settings = Settings()
    version: str = "unknown"
    description: str = ""


@dataclass(frozen=True)
class Spec:
    dataflows: tuple[Dataflow, ...]
    version: str = "unknown"
    description: str = ""

    @staticmethod
    def from_dict(document: Mapping[str, Any]) -> Spec:
        """Parse and check a spec; the caller's document is never changed."""
        flows = document.get("dataflows")
        if not isinstance(flows, list) or not flows:
            raise SpecError("'dataflows' must be a non-empty list")
        document = copy.deepcopy(dict(document))
        parsed = tuple(_dataflow(flow) for flow in document["dataflows"])
        names = [flow.name for flow in parsed]
        if len(set(names)) != len(names):
            raise SpecError(f"dataflow names repeat: {names}")
        return Spec(parsed, str(document.get("version", "unknown")), document.get("description", ""))

    @staticmethod
    def from_json(text: str) -> Spec:
        return Spec.from_dict(json.loads(text))

    def dataflow(self, name: str | None = None) -> Dataflow:
        """The dataflow called ``name``; the first one when no name is given."""
        if name is None:
            return self.dataflows[0]
        for flow in self.dataflows:
            if flow.name == name:
                return flow
        raise SpecError(f"no dataflow named {name!r}; known: {[f.name for f in self.dataflows]}")


def check_source(config: Mapping[str, Any]) -> None:
    """A source needs a name, a path and a known format."""
    _require(config, ("name", "path", "format"), "source")
    _one_of(str(config["format"]).lower(), FORMATS, f"format of source {config['name']!r}")


def check_sink(config: Mapping[str, Any]) -> None:
    """A sink needs a name, paths, a known format and a known save mode."""
    _require(config, ("name", "paths", "format"), "sink")
    name = config["name"]
    if not isinstance(config["paths"], list) or not config["paths"]:
        raise SpecError(f"'paths' of sink {name!r} must be a non-empty list")
    _one_of(str(config["format"]).lower(), FORMATS, f"format of sink {name!r}")
    _one_of(str(config.get("saveMode", "ERROR")).lower(), SAVE_MODES, f"saveMode of sink {name!r}")


def check_step(step: Step) -> None:
    """The checks on a step that need only its parameters."""
    _one_of(step.type, STEP_TYPES, f"type of step {step.name!r}")
    params, where = step.params, f"step {step.name!r}"
    needed = {
        "filter": ("condition",),
        "join": ("right",),
        "union": ("inputs",),
        "aggregate": ("groupBy", "aggregations"),
        "pivot": ("pivotColumn", "valueColumn"),
        "window": ("function", "alias"),
        "select_columns": ("columns",),
    }.get(step.type, ())
    for key in needed:
        if not params.get(key):
            raise SpecError(f"{where} ({step.type}) needs a non-empty '{key}'")
    if step.type == "join" and not any(params.get(key) for key in ("on", "between", "overlaps")):
        raise SpecError(f"{where} (join) needs 'on', 'between' or 'overlaps'")
    if params.get("onMissing", "error") not in ("error", "skip"):
        raise SpecError(f"{where}: onMissing must be 'error' or 'skip'")
    if step.type == "validate_fields" and len(set(step.outputs)) != 2:
        raise SpecError(f"{where}: valid_output and invalid_output must differ")
    for name in step.inputs:
        if not isinstance(name, str) or not name:
            raise SpecError(f"{where} needs an 'input'")


def _dataflow(config: Mapping[str, Any]) -> Dataflow:
    sources = []
    for source in config.get("sources") or []:
        source = {"format": "json", **source}
        check_source(source)
        sources.append(
            Source(
                source["name"],
                source["path"],
                source["format"].lower(),
                source.get("options") or {},
                source.get("schema"),
            )
        )
    steps = []
    for position, step in enumerate(config.get("transformations") or [], 1):
        if "type" not in step:
            raise SpecError(f"transformation {position} has no 'type'")
        parsed = Step(step.get("name", f"transform_{position}"), step["type"], step.get("params") or {})
        check_step(parsed)
        steps.append(parsed)
    sinks = []
    for position, sink in enumerate(config.get("sinks") or [], 1):
        sink = {"name": f"sink_{position}", "format": "json", **sink}
        check_sink(sink)
        if not sink.get("input"):
            raise SpecError(f"sink {sink['name']!r} needs an 'input'")
        sinks.append(
            Sink(
                sink["name"],
                sink["input"],
                tuple(sink["paths"]),
                sink["format"].lower(),
                str(sink.get("saveMode", "ERROR")).lower(),
                tuple(sink.get("partitionBy") or ()),
                sink.get("options") or {},
                bool(sink.get("overwritePartitions", False)),
                None if sink.get("rebalance") is None else bool(sink["rebalance"]),
            )
        )
    settings = config.get("settings") or {}
    staging = settings.get("staging", "auto")
    _one_of(staging, ("auto", "always", "never"), "settings.staging")
    audit = settings.get("audit") or {}
    if audit and set(audit) != {"runs", "logs"}:
        raise SpecError("settings.audit needs the paths 'runs' and 'logs'")
    flow = Dataflow(
        config.get("name", "unnamed"),
        tuple(sources),
        tuple(steps),
        tuple(sinks),
        Settings(settings.get("spark") or {}, settings.get("quality_rules") or {}, staging, bool(settings.get("preflight", False)), audit),
        str(config.get("version", "unknown")),
        config.get("description", ""),
    )
    _check_names(flow)
    return flow


def _check_names(flow: Dataflow) -> None:
    """Every input must name a source or an earlier step."""
    source_names = [source.name for source in flow.sources]
    if len(set(source_names)) != len(source_names):
        raise SpecError(f"source names repeat: {source_names}")
    known = set(source_names)
    for step in flow.steps:
        for name in step.inputs:
            if name not in known:
                raise SpecError(f"input {name!r} of step {step.name!r} not found; known: {sorted(known)}")
        known.update(step.outputs)
    for sink in flow.sinks:
        if sink.input not in known:
            raise SpecError(f"input {sink.input!r} of sink {sink.name!r} not found; known: {sorted(known)}")


def _require(config: Mapping[str, Any], keys, what: str) -> None:
    for key in keys:
        if key not in config:
            raise SpecError(f"missing required field in {what}: {key}")


def _one_of(value, allowed, what: str) -> None:
    if value not in allowed:
        raise SpecError(f"{what}: {value!r} is not one of {list(allowed)}")
