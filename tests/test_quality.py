import pytest

from recordflow import QualityGateError
from recordflow.operators import quality
from recordflow.operators.validate import mark, split
from tests.conftest import rows

RULES = [{"field": "v", "validations": ["notNull", {"type": "inList", "params": {"values": ["a", "b"]}}]}]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "z"), (None, "b")], "k int, v string")


def test_summary(data):
    assert rows(quality.summary(mark(data, RULES))) == [(5, 3, 2, 60.0)]
    assert rows(quality.summary(mark(data.filter("false"), RULES))) == [(0, 0, 0, None)]


def test_breakdown(data):
    breakdown = quality.reject_breakdown(split(data, RULES).rejected)
    assert set(rows(breakdown)) == {("v", "v cannot be null", 1), ("v", "v must be one of ['a', 'b']", 1)}


def test_duplicates_count_null_as_a_key(data):
    assert rows(quality.duplicates(data, ["k"])) == [(5, 3, 2, 40.0)]
    assert rows(quality.duplicates(data)) == [(5, 4, 1, 20.0)]
    assert rows(quality.duplicates(data.filter("false"), ["k"])) == [(0, 0, 0, None)]


def test_gates():
    def measured(total, value):
        return {"total_records": total, "valid_percentage": value, "duplicate_percentage": value}

    assert quality.min_valid_gate(measured(5, 80.0)).passed
    assert not quality.min_valid_gate(measured(5, 79.99)).passed
    assert quality.min_valid_gate(measured(5, 10.0), 10).passed
    assert quality.min_valid_gate(measured(0, None)).message == "No records processed"
    assert quality.max_duplicate_gate(measured(5, 5.0), 5).passed
    assert quality.max_duplicate_gate(measured(0, None), 5).passed
    failed = quality.max_duplicate_gate(measured(5, 5.1), 5)
    with pytest.raises(QualityGateError, match="5.10% duplicate records"):
        quality.require([quality.min_valid_gate(measured(5, 80.0)), failed])
