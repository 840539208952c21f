import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from recordflow import Sink, Source, SpecError
from recordflow.operators.validate import ERRORS, split
from recordflow.sinks.writers import OPEN_FILES, OPEN_FILES_CONF, snapshot, write_sink, write_sinks
from recordflow.sources.readers import preflight, read_source, read_sources, require_input
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([(1, "a", None), (2, "b", 2.5), (3, "b", 3.5)], "id int, g string, v double")


def sink(path, format="parquet", mode="error", **more):
    return Sink("k", "data", (str(path),), format, mode, **more)


@pytest.mark.parametrize("format, options", [("json", {}), ("csv", {"header": True, "sep": "|"}), ("parquet", {})])
def test_write_and_read(spark, data, tmp_path, format, options):
    write_sink(data, sink(tmp_path / "o", format, options=options))
    source = Source("s", str(tmp_path / "o"), format, options, "id int, g string, v double")
    assert rows(read_source(spark, source)) == rows(data)


def test_csv_without_schema_has_text_or_inferred_columns(spark, data, tmp_path):
    write_sink(data, sink(tmp_path / "o", "csv", options={"header": True}))
    path = str(tmp_path / "o")
    assert dict(read_source(spark, Source("s", path, "csv", {"header": True})).dtypes)["id"] == "string"
    inferred = read_source(spark, Source("s", path, "csv", {"header": True, "inferSchema": True}))
    assert dict(inferred.dtypes)["id"] == "int"


def test_multiline_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1,\n "g": "x"},\n {"id": 2}]')
    source = Source("s", str(tmp_path), "json", {"multiLine": True})
    assert rows(read_source(spark, source), "id", "g") == [(1, "x"), (2, None)]


def test_glob_and_several_sources(spark, tmp_path):
    for name in ("a1", "a2", "b1"):
        (tmp_path / f"{name}.json").write_text('{"id": 1}\n')
    frames = read_sources(
        spark,
        [Source("a", f"{tmp_path}/a*.json"), Source("b", f"{tmp_path}/b*.json"), Source("c", [f"{tmp_path}/a1.json"])],
    )
    assert {name: frame.count() for name, frame in frames.items()} == {"a": 2, "b": 1, "c": 1}


def test_avro_without_its_package_is_a_spec_error(spark, data, tmp_path):
    try:
        spark.read.format("avro").load([])
        pytest.skip("the avro package is present")
    except AnalysisException:
        pass
    with pytest.raises(SpecError, match="spark-avro"):
        read_source(spark, Source("s", str(tmp_path), "avro"))
    with pytest.raises(SpecError, match="spark-avro"):
        write_sink(data, sink(tmp_path / "o", "avro"))


def test_json_sink_keeps_nulls(data, tmp_path):
    write_sink(data, sink(tmp_path / "o", "json"))
    lines = "".join(open(path).read() for path in glob.glob(f"{tmp_path}/o/*.json"))
    assert '"v":null' in lines
    write_sink(data, sink(tmp_path / "p", "json", options={"ignoreNullFields": "true"}))
    assert "null" not in "".join(open(path).read() for path in glob.glob(f"{tmp_path}/p/*.json"))


def test_save_modes(spark, data, tmp_path):
    path = tmp_path / "o"
    write_sink(data, sink(path))
    with pytest.raises(AnalysisException):
        write_sink(data, sink(path, mode="error"))
    write_sink(data, sink(path, mode="ignore"))
    assert spark.read.parquet(str(path)).count() == 3
    write_sink(data, sink(path, mode="append"))
    assert spark.read.parquet(str(path)).count() == 6
    write_sink(data, sink(path, mode="overwrite"))
    assert spark.read.parquet(str(path)).count() == 3
    write_sink(data, sink(tmp_path / "fresh", mode="ignore"))
    assert spark.read.parquet(str(tmp_path / "fresh")).count() == 3


@pytest.mark.parametrize("rebalance", [False, True])
def test_partitioned_write(spark, data, tmp_path, rebalance):
    write_sink(data, sink(tmp_path / "o", partition_by=("g",), rebalance=rebalance))
    assert sorted(name for name in os.listdir(tmp_path / "o") if "=" in name) == ["g=a", "g=b"]
    part = spark.read.parquet(glob.glob(f"{tmp_path}/o/g=a/*.parquet")[0])
    assert part.columns == ["id", "v"]
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id", "g", "v") == rows(data)


@pytest.mark.parametrize("rebalance", [False, True])
def test_rows_that_no_shuffle_sized_are_not_sorted(spark, tmp_path, monkeypatch, rebalance):
    """A task has files open for some values at once; rows of further values come after a sort, and none is lost."""
    seen, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda *a, **k: seen.append(spark.conf.get(OPEN_FILES_CONF, None)) or save(*a, **k))
    many = spark.range(0, 4000, 1, 2).withColumn("g", F.col("id") % (3 * OPEN_FILES))
    write_sink(many, sink(tmp_path / "o", partition_by=("g",), rebalance=rebalance))
    assert seen == [None if rebalance else str(OPEN_FILES)]
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id", "g") == rows(many)
    if not rebalance:
        assert len(glob.glob(f"{tmp_path}/o/g=*/*.parquet")) == 2 * 3 * OPEN_FILES

    assert spark.conf.get(OPEN_FILES_CONF, None) is None
    spark.conf.set(OPEN_FILES_CONF, "3")
    try:
        write_sink(many, sink(tmp_path / "own", partition_by=("g",), rebalance=rebalance))
        assert seen[-1] == spark.conf.get(OPEN_FILES_CONF) == "3"
    finally:
        spark.conf.unset(OPEN_FILES_CONF)


def test_fan_out(spark, data, tmp_path):
    write_sink(data, Sink("k", "data", (str(tmp_path / "a"), str(tmp_path / "b")), "parquet"))
    assert rows(spark.read.parquet(str(tmp_path / "a"))) == rows(spark.read.parquet(str(tmp_path / "b"))) == rows(data)


def test_partition_overwrite_touches_only_its_partitions(spark, data, tmp_path):
    target = dict(partition_by=("g",), overwrite_partitions=True)
    write_sink(data, sink(tmp_path / "o", mode="overwrite", **target))
    for _ in range(2):
        write_sink(data.filter("g = 'b'").withColumn("v", F.lit(0.0)), sink(tmp_path / "o", mode="overwrite", **target))
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id", "v") == [(1, None), (2, 0.0), (3, 0.0)]


def test_bad_sinks(data, tmp_path):
    for columns in (("id", "g", "v"), ("nope",)):
        with pytest.raises(SpecError):
            write_sink(data, sink(tmp_path / "o", partition_by=columns))
    assert not (tmp_path / "o").exists()


def test_all_sinks_are_tried(spark, data, tmp_path):
    snapshot(data, str(tmp_path / "taken"))
    sinks = [
        Sink("bad", "data", (str(tmp_path / "taken"),), "parquet"),
        Sink("unknown", "nope", (str(tmp_path / "x"),), "parquet"),
        Sink("good", "data", (str(tmp_path / "good"),), "parquet"),
    ]
    assert write_sinks({"data": data}, sinks) == {"bad": False, "unknown": False, "good": True}


def test_snapshot_overwrites(spark, data, tmp_path):
    snapshot(data, str(tmp_path / "s"))
    snapshot(data.limit(1), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1


def test_preflight(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="folder not found"):
        require_input(spark, str(tmp_path / "none"))
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError, match="no file matches"):
        require_input(spark, str(tmp_path))
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text("{}")
    assert require_input(spark, str(tmp_path)) == 2
    assert rows(preflight(spark, str(tmp_path)), "file_name", "length") == [("a.json", 2), ("b.json", 2)]


def test_lines_that_do_not_parse_are_rejected(spark, tmp_path):
    """A pretty-printed object next to the data gives one corrupt line each, not rows of NULLs."""
    (tmp_path / "data.json").write_text('{"id": 1, "g": "x"}\n{"id": 2, "g": ""}\n{"id": 3, "g"\n')
    (tmp_path / "summary.json").write_text('{\n  "total": 3\n}\n')
    for schema in (None, "id int, g string, _corrupt_record string"):
        lines = read_source(spark, Source("s", str(tmp_path), "json", {}, schema))
        parts = split(lines, [{"field": "g", "validations": ["notEmpty"]}])
        assert rows(parts.valid, "id") == [(1,)]
        rejected = [set(row[ERRORS]) for row in parts.rejected.collect()]
        assert len(rejected) == 5
        assert sum("_corrupt_record" in keys for keys in rejected) == 4
