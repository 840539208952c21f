"""The flagship flow: validation, a computed field and an aggregate, compiled from one spec."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.plans.flow import CompiledFlow
from workload.registry import query, table
from workload.validation import ALL_NULL_SQL, ANNOTATED_SQL, RULES

SPEC = {
    "version": "1.0.0",
    "dataflows": [
        {
            "name": "premium-by-vehicle",
            "sources": [{"name": "policies", "path": "given", "format": "PARQUET"}],
            "transformations": [
                {"name": "check", "type": "validate_fields", "params": {"input": "policies", "validations": RULES}},
                {
                    "name": "grouped",
                    "type": "add_fields",
                    "params": {
                        "input": "validation_ok",
                        "addFields": [
                            {
                                "name": "price_band",
                                "function": "when",
                                "condition": "premium > 20000",
                                "then": "upper",
                                "otherwise": "lower",
                            },
                            {"name": "premium", "function": "cast", "column": "premium", "type": "decimal(18,3)"},
                        ],
                    },
                },
                {
                    "name": "totals",
                    "type": "aggregate",
                    "params": {
                        "input": "grouped",
                        "groupBy": ["vehicle_type", "price_band"],
                        "aggregations": [
                            {"function": "sum", "column": "premium", "alias": "total_premium"},
                            {"function": "avg", "column": "driver_age", "alias": "avg_age"},
                            {"function": "count", "column": "policy_number", "alias": "n_policies"},
                        ],
                    },
                },
            ],
        }
    ],
}


@query(
    "premium_by_vehicle",
    f"""
    SELECT vehicle_type, CASE WHEN premium > 20000 THEN 'upper' ELSE 'lower' END AS price_band,
      CAST(sum(CAST(premium AS DECIMAL(18,3))) AS DECIMAL(28,3)) AS total_premium,
      round(avg(driver_age), 6) AS avg_age, count(policy_number) AS n_policies
    FROM ({ANNOTATED_SQL}) t WHERE {ALL_NULL_SQL} GROUP BY 1, 2
    """,
)
def premium_by_vehicle(spark, sf_dir):
    compiled = CompiledFlow(spark, SPEC, inputs={"policies": table(spark, sf_dir, "policies")})
    return compiled.frames["totals"].withColumn("avg_age", F.round("avg_age", 6))
