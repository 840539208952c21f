import copy

import pytest

from recordflow import Spec, SpecError
from recordflow.plans.spec import check_sink, check_source


def document(**flow):
    base = {
        "name": "f",
        "sources": [{"name": "s", "path": "/data/*.json", "format": "JSON"}],
        "transformations": [{"name": "t", "type": "filter", "params": {"input": "s", "condition": "a > 1"}}],
        "sinks": [{"input": "t", "name": "k", "paths": ["/out"], "format": "PARQUET", "saveMode": "APPEND"}],
    }
    return {"version": "1.0.0", "dataflows": [{**base, **flow}]}


def test_parses_and_leaves_the_document_unchanged():
    text = document()
    before = copy.deepcopy(text)
    flow = Spec.from_dict(text).dataflow()
    assert text == before
    assert (flow.sources[0].format, flow.sinks[0].mode, flow.sinks[0].format) == ("json", "append", "parquet")
    assert Spec.from_dict(text).dataflow("f").name == "f"


def test_defaults():
    flow = Spec.from_dict(
        document(
            sources=[{"name": "s", "path": "p"}],
            transformations=[{"type": "filter", "params": {"input": "s", "condition": "true"}}],
            sinks=[{"input": "transform_1", "paths": ["o"]}],
        )
    ).dataflow()
    assert flow.sources[0].format == "json"
    assert flow.steps[0].name == "transform_1"
    assert (flow.sinks[0].name, flow.sinks[0].mode) == ("sink_1", "error")


def test_validation_outputs_have_default_names():
    step = {"name": "v", "type": "validate_fields", "params": {"input": "s", "validations": []}}
    flow = Spec.from_dict(document(transformations=[step], sinks=[])).dataflow()
    assert flow.steps[0].outputs == ("validation_ok", "validation_ko")


@pytest.mark.parametrize(
    "change, message",
    [
        ({"sources": [{"name": "s", "path": "p", "format": "xml"}]}, "xml"),
        ({"sources": [{"name": "s"}]}, "path"),
        ({"sinks": [{"input": "t", "name": "k", "paths": ["o"], "format": "JSON", "saveMode": "MERGE"}]}, "saveMode"),
        ({"sinks": [{"input": "nope", "name": "k", "paths": ["o"], "format": "JSON"}]}, "nope"),
        ({"sinks": [{"input": "t", "name": "k", "paths": [], "format": "JSON"}]}, "paths"),
        ({"transformations": [{"name": "t", "type": "explode", "params": {"input": "s"}}]}, "explode"),
        ({"transformations": [{"name": "t", "type": "filter", "params": {"input": "s"}}]}, "condition"),
        ({"transformations": [{"name": "t", "type": "filter", "params": {"input": "x", "condition": "true"}}]}, "'x'"),
        ({"transformations": [{"name": "t", "type": "aggregate", "params": {"input": "s", "groupBy": []}}]}, "groupBy"),
        ({"transformations": [{"name": "t", "type": "select_columns", "params": {"input": "s"}}]}, "columns"),
        ({"settings": {"staging": "sometimes"}}, "staging"),
    ],
)
def test_bad_specs_are_refused(change, message):
    with pytest.raises(SpecError, match=message):
        Spec.from_dict(document(**change))


def test_document_without_dataflows():
    for text in ({}, {"dataflows": []}, {"dataflows": {}}):
        with pytest.raises(SpecError, match="dataflows"):
            Spec.from_dict(text)


def test_source_and_sink_checks_need_all_fields():
    check_source({"name": "s", "path": "p", "format": "CSV"})
    check_sink({"name": "s", "paths": ["p"], "format": "avro", "saveMode": "IGNORE"})
    for missing in ("name", "path", "format"):
        config = {"name": "s", "path": "p", "format": "csv"}
        del config[missing]
        with pytest.raises(SpecError, match=missing):
            check_source(config)
    for missing in ("name", "paths", "format"):
        config = {"name": "s", "paths": ["p"], "format": "csv"}
        del config[missing]
        with pytest.raises(SpecError, match=missing):
            check_sink(config)
