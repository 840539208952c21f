"""Sources, sinks and whole flows. Everything is written below the session's checkpoint folder."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordflow.operators.validate import ERRORS, split
from recordflow.plans.flow import CompiledFlow
from recordflow.plans.spec import Sink, Source
from recordflow.plans.staging import StagingArea
from recordflow.sinks.writers import snapshot, write_sink, write_sinks
from recordflow.sources.readers import preflight, read_source, read_sources
from workload.registry import query, table
from workload.validation import POLICY_COLUMNS

RUN_TIME = datetime.datetime(2025, 11, 19, 10, 21, 42, tzinfo=datetime.timezone.utc)


def _policies_at(spark, sf_dir, area, **sink):
    """The policies written to one fresh path; the frame and the path."""
    policies = table(spark, sf_dir, "policies")
    path = area.new_path("policies")
    write_sink(policies, Sink("policies", "policies", (path,), **sink))
    return policies, path


@query("src_json", f"SELECT {POLICY_COLUMNS} FROM policies")
def src_json(spark, sf_dir):
    policies, path = _policies_at(spark, sf_dir, StagingArea(spark), format="json")
    return read_source(spark, Source("policies", path, "json", {"multiLine": False}, _ddl(policies)))


@query("src_csv", f"SELECT {POLICY_COLUMNS} FROM policies")
def src_csv(spark, sf_dir):
    """With a text for NULL, NULL and the empty string stay different."""
    options = {"header": True, "sep": ";", "nullValue": "NULL"}
    policies, path = _policies_at(spark, sf_dir, StagingArea(spark), format="csv", options=options)
    return read_source(spark, Source("policies", path, "csv", options, _ddl(policies)))


@query("src_parquet", f"SELECT {POLICY_COLUMNS} FROM policies")
def src_parquet(spark, sf_dir):
    _, path = _policies_at(spark, sf_dir, StagingArea(spark), format="parquet")
    return read_source(spark, Source("policies", path, "parquet"))


@query("src_glob", f"SELECT {POLICY_COLUMNS} FROM policies WHERE vehicle_type IN ('sedan', 'suv')")
def src_glob(spark, sf_dir):
    """A wildcard in the path picks the folders of two vehicle types."""
    policies, path = _policies_at(
        spark, sf_dir, StagingArea(spark), format="json", partition_by=("vehicle_type",)
    )
    source = Source("policies", f"{path}/vehicle_type=s*", "json", {"basePath": path}, _ddl(policies))
    return read_source(spark, source).select(*policies.columns)


@query(
    "src_multi",
    "SELECT 'customer' AS source, count(*) AS n_rows FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier",
)
def src_multi(spark, sf_dir):
    sources = [Source(name, f"{sf_dir}/{name}.parquet", "parquet") for name in ("customer", "supplier")]
    frames = read_sources(spark, sources)
    counts = [frame.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows")) for name, frame in frames.items()]
    return counts[0].unionByName(counts[1])


@query(
    "src_corrupt_lines",
    """
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE o_orderkey % 53 = 0) AS n_corrupt,
      count(*) FILTER (WHERE o_orderkey % 53 <> 0 AND (policy_number IS NULL OR trim(policy_number) = '')) AS n_other
    FROM policies
    """,
)
def src_corrupt_lines(spark, sf_dir):
    """Lines cut short in transfer become rejects with their own error key."""
    policies, path = table(spark, sf_dir, "policies"), StagingArea(spark).new_path("lines")
    line = F.to_json(F.struct(*policies.columns))
    broken = F.expr("left(line, length(line) - 5)")
    sent = policies.select("age_text", line.alias("line"))
    sent.select(F.when(F.col("age_text") == "n/a", broken).otherwise(F.col("line")).alias("value")).write.text(path)
    lines = read_source(spark, Source("lines", path, "json", {}, _ddl(policies) + ", _corrupt_record string"))
    parts = split(lines, [{"field": "policy_number", "validations": ["notEmpty"]}])
    corrupt = F.col(ERRORS)["_corrupt_record"].isNotNull()
    passed = parts.valid.select(F.lit(False).alias("corrupt"), F.lit(False).alias("reject"))
    everything = parts.rejected.select(corrupt.alias("corrupt"), F.lit(True).alias("reject")).unionByName(passed)
    return everything.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("corrupt").alias("n_corrupt"),
        F.count_if(F.col("reject") & ~F.col("corrupt")).alias("n_other"),
    )


@query("sink_partitioned", f"SELECT {POLICY_COLUMNS} FROM policies")
def sink_partitioned(spark, sf_dir):
    """Two partition columns, one with NULLs; they come back from the directory names."""
    policies, path = _policies_at(
        spark, sf_dir, StagingArea(spark), format="parquet", partition_by=("coverage_type", "vehicle_type"), rebalance=True
    )
    return read_source(spark, Source("policies", path, "parquet")).select(*policies.columns)


@query(
    "sink_modes",
    "SELECT 'append' AS mode, 2 * count(*) AS n_rows, true AS accepted FROM policies "
    "UNION ALL SELECT 'error', count(*), false FROM policies "
    "UNION ALL SELECT 'ignore', count(*), true FROM policies "
    "UNION ALL SELECT 'overwrite', count(*), true FROM policies",
)
def sink_modes(spark, sf_dir):
    """Rows on disk after a second write in each mode, and whether that write was accepted."""
    area, results = StagingArea(spark), []
    for mode in ("append", "error", "ignore", "overwrite"):
        policies, path = _policies_at(spark, sf_dir, area, format="parquet")
        accepted = True
        try:
            write_sink(policies, Sink("again", "policies", (path,), "parquet", mode))
        except AnalysisException:
            accepted = False
        written = spark.read.parquet(path)
        results.append(
            written.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_rows"), F.lit(accepted).alias("accepted"))
        )
    first, *others = results
    for other in others:
        first = first.unionByName(other)
    return first


@query(
    "sink_fanout",
    "SELECT copy, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys "
    "FROM policies CROSS JOIN (VALUES ('a'), ('b')) c(copy) GROUP BY copy",
)
def sink_fanout(spark, sf_dir):
    """One sink, two paths."""
    area = StagingArea(spark)
    paths = (area.new_path("a"), area.new_path("b"))
    write_sink(table(spark, sf_dir, "policies"), Sink("copies", "policies", paths, "parquet"))
    copies = [spark.read.parquet(path).withColumn("copy", F.lit(name)) for path, name in zip(paths, ("a", "b"))]
    both = copies[0].unionByName(copies[1])
    return both.groupBy("copy").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys"))


@query(
    "sink_partition_overwrite",
    "SELECT vehicle_type, count(*) AS n_rows, "
    "count(*) FILTER (WHERE vehicle_type = 'suv') AS n_new FROM policies GROUP BY vehicle_type",
)
def sink_partition_overwrite(spark, sf_dir):
    """A re-run replaces only the partitions it writes, so nothing is ingested twice."""
    policies = table(spark, sf_dir, "policies").select("o_orderkey", "vehicle_type", F.lit(0).alias("run"))
    path = StagingArea(spark).new_path("rerun")
    by_type = ("vehicle_type",)
    write_sink(policies, Sink("first", "policies", (path,), "parquet", partition_by=by_type))
    rerun = policies.filter("vehicle_type = 'suv'").withColumn("run", F.lit(1))
    write_sink(rerun, Sink("second", "rerun", (path,), "parquet", "overwrite", by_type, {}, True))
    written = spark.read.parquet(path)
    return written.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("run") == 1).alias("n_new"))


@query(
    "sink_multi",
    "SELECT 'bad' AS sink, false AS done, count(*) AS n_policies FROM policies "
    "UNION ALL SELECT 'good', true, count(*) FROM policies",
)
def sink_multi(spark, sf_dir):
    """One failing sink does not stop the others."""
    area = StagingArea(spark)
    policies = table(spark, sf_dir, "policies")
    good, taken = area.new_path("good"), area.new_path("bad")
    snapshot(policies.select("o_orderkey"), taken)
    sinks = [
        Sink("bad", "policies", (taken,), "parquet"),
        Sink("good", "policies", (good,), "parquet"),
    ]
    done = write_sinks({"policies": policies}, sinks)
    outcome = F.create_map(*[F.lit(part) for pair in done.items() for part in pair])
    count = spark.read.parquet(good).agg(F.count(F.lit(1)).alias("n_policies"))
    return count.select(F.explode(outcome).alias("sink", "done"), "n_policies")


@query("snapshot", f"SELECT {POLICY_COLUMNS} FROM policies")
def snapshot_copy(spark, sf_dir):
    path = StagingArea(spark).new_path("snapshot")
    policies = table(spark, sf_dir, "policies")
    snapshot(policies.drop("premium"), path)
    snapshot(policies, path)
    return spark.read.parquet(path)


@query(
    "preflight",
    "SELECT vehicle_type AS folder, true AS has_files, true AS has_bytes FROM policies GROUP BY vehicle_type",
)
def preflight_files(spark, sf_dir):
    """The input files of a folder, found without reading them."""
    _, path = _policies_at(spark, sf_dir, StagingArea(spark), format="json", partition_by=("vehicle_type",))
    files = preflight(spark, f"{path}/*").withColumn("folder", F.regexp_extract("path", "vehicle_type=([^/]+)/", 1))
    return files.groupBy("folder").agg(
        (F.count(F.lit(1)) > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")
    )


# JSON repeats its field names in every row. The lowest level of gzip takes most of that off and costs little more than plain text.
# A compressed file can't be split, so files are kept small.
PACKED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}

LINE_RULES = [
    {"field": "l_quantity", "validations": [{"type": "rangeCheck", "params": {"min": 3, "max": 45}}], "error_message": "odd lot"},
    {"field": "l_returnflag", "validations": [{"type": "inList", "params": {"values": ["A", "N"]}}], "error_message": "sent back"},
]


def shipment_spec(area: StagingArea, min_valid: float = 20) -> dict:
    """Order lines: odd lots and returns go to a feed, the rest to facts by year and to totals per supplier."""
    priced = [
        {"name": "net", "function": "expr", "expression": "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,2))"},
        {"name": "ship_year", "function": "year", "column": "l_shipdate"},
        {"name": "line_key", "function": "concat", "columns": ["l_orderkey", "l_linenumber"], "separator": "-"},
        {"name": "ticket", "function": "uuid"},
        {"name": "loaded", "function": "current_timestamp"},
    ]
    totals = [
        {"function": "sum", "column": "net", "alias": "revenue"},
        {"function": "count", "column": "*", "alias": "n_lines"},
    ]
    steps = [
        {"name": "lots", "type": "validate_fields", "params": {"input": "lines", "validations": LINE_RULES}},
        {
            "name": "one_per_line",
            "type": "deduplicate",
            "params": {
                "input": "validation_ok",
                "subset": ["l_orderkey", "l_linenumber"],
                "orderBy": ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"],
            },
        },
        {"name": "priced", "type": "add_fields", "params": {"input": "one_per_line", "addFields": priced}},
        {"name": "facts", "type": "drop_columns", "params": {"input": "priced", "columns": ["l_tax", "l_discount"]}},
        {
            "name": "suppliers",
            "type": "aggregate",
            "params": {"input": "facts", "groupBy": ["l_suppkey"], "aggregations": totals},
        },
        {
            "name": "faulty",
            "type": "add_fields",
            "params": {"input": "validation_ko", "addFields": [{"name": "seen_on", "function": "current_date"}]},
        },
    ]
    return {
        "version": "2.3",
        "dataflows": [
            {
                "name": "shipments",
                "sources": [{"name": "lines", "path": "given", "format": "JSON"}],
                "transformations": steps,
                "sinks": [
                    {"input": "facts", "name": "by-year", "paths": [area.new_path("facts")], "format": "PARQUET",
                     "saveMode": "OVERWRITE", "partitionBy": ["ship_year"], "rebalance": False, "options": {"compression": "zstd"}},
                    {"input": "facts", "name": "feed", "paths": [area.new_path("feed")], "format": "JSON",
                     "saveMode": "APPEND", "options": PACKED_JSON},
                    {"input": "suppliers", "name": "totals", "paths": [area.new_path("totals")], "format": "PARQUET"},
                    {"input": "faulty", "name": "returned", "paths": [area.new_path("faulty")], "format": "JSON",
                     "saveMode": "APPEND", "partitionBy": ["seen_on"], "options": PACKED_JSON},
                ],
                "settings": {"quality_rules": {"min_valid_record_percentage": min_valid}},
            }
        ],
    }


def run_shipments(spark, sf_dir, **settings):
    """The shipment spec run over JSON files; the compiled flow and its report."""
    area = StagingArea(spark)
    lines = table(spark, sf_dir, "lineitem")
    path = area.new_path("lines")
    write_sink(lines, Sink("lines", "lines", (path,), "json", options=PACKED_JSON))
    spec = shipment_spec(area)
    spec["dataflows"][0]["sources"][0] |= {"path": path, "schema": _ddl(lines)}
    spec["dataflows"][0]["settings"] |= settings
    compiled = CompiledFlow(spark, spec, run_time=RUN_TIME)
    return compiled, compiled.run()


GOOD_LINES_SQL = "SELECT * FROM lineitem WHERE l_quantity BETWEEN 3 AND 45 AND l_returnflag IN ('A', 'N')"
FACTS_SQL = f"""
SELECT * EXCLUDE (n), CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,2)) AS net, year(l_shipdate)::INTEGER AS ship_year,
  l_orderkey || '-' || l_linenumber AS line_key
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS n FROM ({GOOD_LINES_SQL}) g) d WHERE n = 1
"""


@query(
    "flow_archive",
    f"SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_returnflag, ship_year, line_key FROM ({FACTS_SQL}) f",
)
def flow_archive(spark, sf_dir):
    """A whole run from JSON files to sinks: the facts it leaves."""
    compiled, _ = run_shipments(spark, sf_dir)
    facts = spark.read.parquet(compiled.flow.sinks[0].paths[0])
    return facts.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag", "ship_year", "line_key")


@query("flow_totals", f"SELECT l_suppkey, count(*) AS n_lines FROM ({FACTS_SQL}) f GROUP BY l_suppkey")
def flow_totals(spark, sf_dir):
    """The aggregate that the same run leaves."""
    compiled, _ = run_shipments(spark, sf_dir)
    return spark.read.parquet(compiled.flow.sinks[2].paths[0]).select("l_suppkey", "n_lines")


@query(
    "flow_sinks_agree",
    f"SELECT count(*) AS n_rows, count(*) AS n_same_id FROM ({FACTS_SQL}) f",
)
def flow_sinks_agree(spark, sf_dir):
    """Both sinks of a run hold the same rows with the same random ids and the same timestamp."""
    compiled, _ = run_shipments(spark, sf_dir)
    facts, feed = (sink.paths[0] for sink in compiled.flow.sinks[:2])
    left = spark.read.schema("line_key string, ticket string, loaded timestamp").json(feed)
    right = spark.read.parquet(facts).select("line_key", "ticket", "loaded")
    both = left.alias("a").join(right.alias("b"), "line_key", "full")
    same = (F.col("a.ticket") == F.col("b.ticket")) & (F.col("a.loaded") == F.col("b.loaded"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same_id"))


@query(
    "reject_sink",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity NOT BETWEEN 3 AND 45 THEN 'odd lot' END AS lot,
      CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'sent back' END AS flag, DATE '2025-11-19' AS seen_on
    FROM lineitem WHERE l_quantity NOT BETWEEN 3 AND 45 OR l_returnflag NOT IN ('A', 'N')
    """,
)
def reject_sink(spark, sf_dir):
    """The rejects a run leaves, with their error map and date."""
    compiled, _ = run_shipments(spark, sf_dir)
    schema = "l_orderkey long, l_linenumber int, validation_errors map<string,string>, seen_on date"
    rejects = spark.read.schema(schema).json(compiled.flow.sinks[3].paths[0])
    errors = F.col(ERRORS)
    return rejects.select(
        "l_orderkey", "l_linenumber", errors["l_quantity"].alias("lot"), errors["l_returnflag"].alias("flag"), "seen_on"
    )


@query(
    "stage_metrics",
    f"""
    WITH n AS (SELECT (SELECT count(*) FROM lineitem) AS n_all, (SELECT count(*) FROM ({GOOD_LINES_SQL}) g) AS n_good,
      (SELECT count(*) FROM ({FACTS_SQL}) f) AS n_facts, (SELECT count(DISTINCT l_suppkey) FROM ({FACTS_SQL}) f) AS n_suppliers)
    SELECT 'ingestion' AS stage, 'lines' AS name, n_all AS n_rows FROM n
    UNION ALL SELECT 'transformation', 'lots', n_all FROM n
    UNION ALL SELECT 'transformation', 'one_per_line', n_good FROM n
    UNION ALL SELECT 'transformation', 'priced', n_facts FROM n
    UNION ALL SELECT 'transformation', 'facts', n_facts FROM n
    UNION ALL SELECT 'transformation', 'suppliers', n_facts FROM n
    UNION ALL SELECT 'transformation', 'faulty', n_all - n_good FROM n
    UNION ALL SELECT 'storage', 'by-year', n_facts FROM n
    UNION ALL SELECT 'storage', 'feed', n_facts FROM n
    UNION ALL SELECT 'storage', 'totals', n_suppliers FROM n
    UNION ALL SELECT 'storage', 'returned', n_all - n_good FROM n
    """,
)
def stage_metrics(spark, sf_dir):
    """The row counts a run collects: per source, per step input and per sink."""
    _, report = run_shipments(spark, sf_dir)
    rows = []
    for stage in report.stages:
        for item in stage["data"]:
            count = item["record_count"] if "record_count" in item else item["input_counts"][0]
            rows.append((stage["name"], item["name"], count))
    return spark.createDataFrame(rows, "stage string, name string, n_rows long")


def _small_flow(spark, inputs: dict, steps: list, sinks: list[tuple[str, str]], **settings):
    """A flow over given frames with Parquet sinks (input, name); the paths by name and the report."""
    area = StagingArea(spark)
    paths = {name: area.new_path(name) for _, name in sinks}
    flow = {
        "name": "checks",
        "sources": [{"name": name, "path": "given", "format": "JSON"} for name in inputs],
        "transformations": steps,
        "sinks": [{"input": source, "name": name, "paths": [paths[name]], "format": "PARQUET"} for source, name in sinks],
        "settings": settings,
    }
    report = CompiledFlow(spark, {"version": "1", "dataflows": [flow]}, inputs=inputs).run()
    return paths, report


@query(
    "flow_empty_branch",
    "SELECT count(*) AS n_valid, CAST(0 AS BIGINT) AS n_reject_groups, count(*) AS n_counted, 'success' AS status FROM orders",
)
def flow_empty_branch(spark, sf_dir):
    """A run whose validation rejects nothing: the aggregate of the rejects is empty, and all is well."""
    rules = [{"field": "o_orderkey", "validations": ["notNull"]}]
    counts = [{"function": "count", "column": "*", "alias": "n"}]
    steps = [
        {"name": "v", "type": "validate_fields", "params": {"input": "orders", "validations": rules}},
        {"name": "why", "type": "aggregate", "params": {"input": "validation_ko", "groupBy": ["o_orderstatus"], "aggregations": counts}},
    ]
    paths, report = _small_flow(spark, {"orders": table(spark, sf_dir, "orders")}, steps, [("validation_ok", "ok"), ("why", "why")])
    counted = {item["name"]: item["record_count"] for item in report.stages[-1]["data"]}
    valid = spark.read.parquet(paths["ok"]).agg(F.count(F.lit(1)).alias("n_valid"))
    groups = spark.read.parquet(paths["why"]).agg(F.count(F.lit(1)).alias("n_reject_groups"))
    known = valid.join(groups, F.lit(True))
    return known.withColumns({"n_counted": F.lit(counted["ok"]).cast("long"), "status": F.lit(report.status)})


@query("flow_time_rule", "SELECT count(*) AS n_total, CAST(0 AS BIGINT) AS n_both, CAST(0 AS BIGINT) AS n_unexplained FROM orders")
def flow_time_rule(spark, sf_dir):
    """A rule that depends on the time and on chance still splits the rows in two."""
    rules = [
        {"field": "o_orderkey", "validations": [{"type": "custom", "params": {
            "expression": "o_orderkey % 1000 < unix_micros(current_timestamp()) % 1000 OR rand() < 0.3"}}]},
    ]
    steps = [{"name": "v", "type": "validate_fields", "params": {"input": "orders", "validations": rules}}]
    paths, _ = _small_flow(spark, {"orders": table(spark, sf_dir, "orders")}, steps, [("validation_ok", "ok"), ("validation_ko", "ko")])
    valid = spark.read.parquet(paths["ok"]).select("o_orderkey", F.lit(1).alias("ok"), F.lit(0).alias("bare"))
    bad = spark.read.parquet(paths["ko"]).select("o_orderkey", F.lit(0), (F.size(ERRORS) == 0).cast("int"))
    rows = valid.union(bad).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ok").alias("kinds"), F.sum("bare").alias("bare"))
    return rows.agg(
        F.sum("n").alias("n_total"), F.count_if(F.col("kinds") > 1).alias("n_both"), F.sum("bare").cast("long").alias("n_unexplained")
    )


@query("flow_pivot", "SELECT count(*) AS n_cells FROM orders")
def flow_pivot(spark, sf_dir):
    """A pivot without values over random ones: they are looked up in the rows that are pivoted."""
    drawn = [{"name": "drawn", "function": "expr", "expression": "concat('c', int(rand() * 5))"}]
    steps = [
        {"name": "with_draw", "type": "add_fields", "params": {"input": "orders", "addFields": drawn}},
        {"name": "wide", "type": "pivot", "params": {
            "input": "with_draw", "groupBy": ["o_orderstatus"], "pivotColumn": "drawn", "valueColumn": "o_orderkey", "aggregate": "count"}},
    ]
    paths, _ = _small_flow(spark, {"orders": table(spark, sf_dir, "orders")}, steps, [("wide", "wide")])
    wide = spark.read.parquet(paths["wide"])
    cells = [F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in wide.columns if name != "o_orderstatus"]
    return wide.agg(F.sum(sum(cells[1:], cells[0])).alias("n_cells"))


@query(
    "run_report",
    f"""
    SELECT 'shipments' AS metadata_name, 'success' AS status, (SELECT count(*) FROM lineitem) AS total_records,
      count(*) AS valid_records, (SELECT count(*) FROM lineitem) - count(*) AS invalid_records, 3 AS n_stages
    FROM ({GOOD_LINES_SQL}) g
    """,
)
def run_report(spark, sf_dir):
    """The report of a run, written as JSON and read back."""
    _, report = run_shipments(spark, sf_dir)
    path = StagingArea(spark).new_path("report")
    report.write(spark, path)
    document = spark.read.schema(
        "metadata_name string, status string, stages array<string>, quality_metrics "
        "array<struct<total_records:long,valid_records:long,invalid_records:long>>"
    ).json(path)
    return document.select(
        "metadata_name", "status", F.inline("quality_metrics"), F.size("stages").alias("n_stages")
    )


@query(
    "run_history",
    f"""
    WITH n AS (SELECT (SELECT count(*) FROM lineitem) AS total, (SELECT count(*) FROM ({GOOD_LINES_SQL}) g) AS good)
    SELECT 'shipments' AS metadata_name, 'success' AS status, total AS total_records, good AS valid_records,
      CAST(3 AS BIGINT) AS n_stages, CAST(5 AS BIGINT) AS n_lines FROM n
    """,
)
def run_history(spark, sf_dir):
    """The history that a run appends when its settings say where: one run, a line per stage, gate and end."""
    area = StagingArea(spark)
    paths = {"runs": area.new_path("runs"), "logs": area.new_path("logs")}
    run_shipments(spark, sf_dir, audit=paths, preflight=True)
    lines = spark.read.parquet(paths["logs"]).groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("n_lines"))
    runs = spark.read.parquet(paths["runs"]).join(lines, "pipeline_id")
    return runs.select(
        "metadata_name", "status", "total_records", "valid_records", F.size("stages").cast("bigint").alias("n_stages"), "n_lines"
    )


def _ddl(df) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)
