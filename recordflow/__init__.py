"""Declarative data-quality and transformation flows on PySpark."""

from recordflow.errors import FlowFailed, QualityGateError, SpecError
from recordflow.functions.fields import FieldRegistry
from recordflow.functions.rules import RuleRegistry
from recordflow.plans.flow import CompiledFlow, compile_flow, run_flow
from recordflow.plans.report import RunReport
from recordflow.plans.session import TUNING, session_for
from recordflow.plans.spec import Dataflow, Sink, Source, Spec, Step

__all__ = [
    "CompiledFlow",
    "Dataflow",
    "FieldRegistry",
    "FlowFailed",
    "QualityGateError",
    "RuleRegistry",
    "RunReport",
    "Sink",
    "Source",
    "Spec",
    "SpecError",
    "Step",
    "TUNING",
    "compile_flow",
    "run_flow",
    "session_for",
]
