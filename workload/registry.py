"""Registration of queries and of the derived tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The driver tables hold no NULLs and no dirty values, so these tables derive them. The text of
# each runs unchanged on Spark and as the SQL to compare with.
POLICIES = """
SELECT o_orderkey,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN ''
      ELSE concat('POL', CAST(o_orderkey % 9000 AS STRING)) END AS policy_number,
 CASE WHEN o_orderkey % 31 = 0 THEN NULL
      WHEN o_orderkey % 23 = 0 THEN concat('ab', CAST(o_orderkey % 10 AS STRING))
      ELSE concat('ABC-', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')) END AS plate_number,
 CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 10 + o_custkey % 100 END AS driver_age,
 CASE WHEN o_orderkey % 53 = 0 THEN 'n/a' ELSE CAST(10 + o_custkey % 100 AS STRING) END AS age_text,
 CASE WHEN o_orderkey % 19 = 0 THEN 'nobody'
      ELSE concat('user', CAST(o_custkey AS STRING), '@mail.example') END AS email,
 o_totalprice / 5 AS premium,
 CASE o_orderkey % 6 WHEN 0 THEN 'sedan' WHEN 1 THEN 'suv' WHEN 2 THEN 'truck'
      WHEN 3 THEN 'motorcycle' WHEN 4 THEN 'van' ELSE 'boat' END AS vehicle_type,
 CASE o_orderkey % 4 WHEN 0 THEN 'comprehensive' WHEN 1 THEN 'third_party'
      WHEN 2 THEN 'collision' ELSE NULL END AS coverage_type,
 CAST(o_orderdate AS DATE) AS policy_start_date,
 CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS DATE) AS policy_end_date
FROM {orders}
"""

RUNS = """
SELECT concat(CASE WHEN event_id % 3 = 0 THEN 'airflow_' ELSE 'direct_' END,
              CAST(event_id AS STRING)) AS pipeline_id,
 concat('meta_', CAST(user_id % 5 AS STRING)) AS metadata_name,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running'
      WHEN 'click' THEN 'cancelled' ELSE 'success' END AS status,
 ts AS start_time,
 CASE WHEN event_type = 'signup' THEN NULL ELSE ts + INTERVAL 95 SECOND END AS end_time,
 CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS duration_seconds,
 CAST(event_id % 500 + event_id % 37 AS BIGINT) AS total_records,
 CAST(event_id % 500 AS BIGINT) AS valid_records,
 CAST(event_id % 37 AS BIGINT) AS invalid_records
FROM {events}
"""

LOGS = """
SELECT event_id AS log_id,
 concat('run_', CAST(event_id % 1000 AS STRING)) AS pipeline_id,
 ts AS log_time,
 CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' WHEN 'signup' THEN 'CRITICAL'
      WHEN 'click' THEN 'INFO' ELSE 'DEBUG' END AS level,
 CASE event_id % 4 WHEN 0 THEN 'ingestion' WHEN 1 THEN 'transformation'
      WHEN 2 THEN 'storage' ELSE NULL END AS stage,
 concat(event_type, ' ', props) AS message
FROM {events}
"""

DERIVED = {"policies": (POLICIES, "orders"), "runs": (RUNS, "events"), "logs": (LOGS, "events")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or one of the derived tables over it."""
    if name in DERIVED:
        text, base = DERIVED[name]
        return spark.sql(text, **{base: table(spark, sf_dir, base)})
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_derived(sql: str) -> str:
    """The SQL with the derived tables it mentions as common table expressions."""
    used = [name for name in DERIVED if name in sql]
    if not used:
        return sql
    parts = [f"{name} AS ({DERIVED[name][0].format(**{DERIVED[name][1]: DERIVED[name][1]})})" for name in used]
    body = sql.strip()
    # A query with table expressions of its own gets the derived ones in front of them.
    return f"WITH {', '.join(parts)}" + (f", {body[5:]}" if body.startswith("WITH ") else f" {body}")


def query(name: str, oracle: str | None = None):
    """Register a query over (spark, sf_dir) under a name."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = with_derived(oracle)
        return function

    return register
