"""One spec step applied to its input frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from recordflow.errors import SpecError
from recordflow.functions.fields import FieldRegistry
from recordflow.operators import projections, relational, windows
from recordflow.plans.spec import Step
from recordflow.plans.staging import StagingArea


def apply_step(
    step: Step,
    inputs: Sequence[DataFrame],
    fields: FieldRegistry | None = None,
    run_time=None,
    area: StagingArea | None = None,
) -> DataFrame:
    """The output frame of any step but ``validate_fields``, which has two.

    Without a staging area the frame is only planned: no job looks for hot keys.
    """
    first, params = inputs[0], step.params
    builders = {
        "add_fields": lambda: projections.add_fields(first, params, fields, run_time),
        "rename_columns": lambda: projections.rename_columns(first, params),
        "drop_columns": lambda: projections.drop_columns(first, params),
        "select_columns": lambda: projections.select_columns(first, params),
        "filter": lambda: projections.filter_rows(first, params),
        "deduplicate": lambda: relational.deduplicate(first, params),
        "join": lambda: relational.join(first, inputs[1], params, look_for_skew=area is not None),
        "union": lambda: relational.union(inputs, params),
        "aggregate": lambda: relational.aggregate(first, params),
        "pivot": lambda: relational.pivot(first, params),
        "window": lambda: windows.window(first, params, area, planned=area is None),
    }
    if step.type not in builders:
        raise SpecError(f"unknown step type {step.type!r}; known: {list(builders)}")
    return builders[step.type]()
