"""Validators, error maps, splits and quality measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.functions.rules import RuleRegistry
from recordflow.operators import quality
from recordflow.operators.validate import ERRORS, VALID_FLAG, annotate, mark, split
from workload.registry import query, table

# The rules of the policy flow and their messages.
RULES = [
    {
        "field": "policy_number",
        "validations": ["notNull", "notEmpty"],
        "error_message": "Policy number is required",
    },
    {
        "field": "plate_number",
        "validations": [
            "notEmpty",
            {
                "type": "regex",
                "params": {
                    "pattern": "^[A-Z]{3}-[0-9]{3}$",
                    "error_message": "Plate number must be format: ABC-123",
                },
            },
        ],
    },
    {
        "field": "driver_age",
        "validations": [
            "notNull",
            "isNumeric",
            {
                "type": "rangeCheck",
                "params": {"min": 18, "max": 100, "error_message": "Driver age must be between 18 and 100"},
            },
        ],
    },
    {
        "field": "premium",
        "validations": [
            "notNull",
            {
                "type": "rangeCheck",
                "params": {"min": 0, "max": 50000, "error_message": "Premium must be between 0 and 50000"},
            },
        ],
    },
    {
        "field": "vehicle_type",
        "validations": [
            {
                "type": "inList",
                "params": {
                    "values": ["sedan", "suv", "truck", "motorcycle", "van"],
                    "error_message": "Invalid vehicle type",
                },
            }
        ],
    },
    {
        "field": "coverage_type",
        "validations": [
            {
                "type": "inList",
                "params": {
                    "values": ["comprehensive", "third_party", "collision"],
                    "error_message": "Invalid coverage type",
                },
            }
        ],
    },
]

# The first message of each field under RULES, as SQL.
ERROR_SQL = {
    "policy_number": "CASE WHEN policy_number IS NULL OR trim(policy_number) = '' THEN 'Policy number is required' END",
    "plate_number": "CASE WHEN plate_number IS NULL OR trim(plate_number) = '' THEN 'plate_number cannot be empty' "
    "WHEN NOT regexp_matches(plate_number, '^[A-Z]{3}-[0-9]{3}$') THEN 'Plate number must be format: ABC-123' END",
    "driver_age": "CASE WHEN driver_age IS NULL THEN 'driver_age cannot be null' "
    "WHEN driver_age < 18 OR driver_age > 100 THEN 'Driver age must be between 18 and 100' END",
    "premium": "CASE WHEN premium IS NULL THEN 'premium cannot be null' "
    "WHEN premium < 0 OR premium > 50000 THEN 'Premium must be between 0 and 50000' END",
    "vehicle_type": "CASE WHEN vehicle_type NOT IN ('sedan', 'suv', 'truck', 'motorcycle', 'van') "
    "THEN 'Invalid vehicle type' END",
    "coverage_type": "CASE WHEN coverage_type NOT IN ('comprehensive', 'third_party', 'collision') "
    "THEN 'Invalid coverage type' END",
}
ANNOTATED_SQL = "SELECT *, " + ", ".join(f"{sql} AS err_{field}" for field, sql in ERROR_SQL.items()) + " FROM policies"
ALL_NULL_SQL = " AND ".join(f"err_{field} IS NULL" for field in ERROR_SQL)
ERROR_COUNT_SQL = " + ".join(f"CASE WHEN err_{field} IS NULL THEN 0 ELSE 1 END" for field in ERROR_SQL)
POLICY_COLUMNS = (
    "o_orderkey, policy_number, plate_number, driver_age, age_text, email, premium, vehicle_type, "
    "coverage_type, policy_start_date, policy_end_date"
)


@query(
    "valid_split_counts",
    f"SELECT CASE WHEN {ALL_NULL_SQL} THEN 'valid' ELSE 'rejected' END AS outcome, count(*) AS n_rows "
    f"FROM ({ANNOTATED_SQL}) t GROUP BY 1",
)
def valid_split_counts(spark, sf_dir):
    marked = mark(table(spark, sf_dir, "policies"), RULES)
    outcome = F.when(F.col(VALID_FLAG), "valid").otherwise("rejected").alias("outcome")
    return marked.groupBy(outcome).agg(F.count(F.lit(1)).alias("n_rows"))


@query("valid_rows", f"SELECT {POLICY_COLUMNS} FROM ({ANNOTATED_SQL}) t WHERE {ALL_NULL_SQL}")
def valid_rows(spark, sf_dir):
    return split(table(spark, sf_dir, "policies"), RULES).valid


@query(
    "reject_rows",
    f"SELECT {POLICY_COLUMNS}, {', '.join('err_' + field for field in ERROR_SQL)}, "
    f"CAST({ERROR_COUNT_SQL} AS INTEGER) AS n_errors FROM ({ANNOTATED_SQL}) t WHERE NOT ({ALL_NULL_SQL})",
)
def reject_rows(spark, sf_dir):
    rejects = split(table(spark, sf_dir, "policies"), RULES).rejected
    messages = {f"err_{field}": F.col(ERRORS)[field] for field in ERROR_SQL}
    return rejects.withColumns({**messages, "n_errors": F.size(ERRORS)}).drop(ERRORS)


@query(
    "reject_breakdown",
    " UNION ALL ".join(
        f"SELECT '{field}' AS field, err_{field} AS message, count(*) AS n_rows FROM ({ANNOTATED_SQL}) t "
        f"WHERE err_{field} IS NOT NULL GROUP BY 2"
        for field in ERROR_SQL
    ),
)
def reject_breakdown(spark, sf_dir):
    return quality.reject_breakdown(split(table(spark, sf_dir, "policies"), RULES).rejected)


@query(
    "reject_details",
    """
    SELECT field, rule, count(*) AS n_rows FROM (
      SELECT 'policy_number' AS field, 'notNull' AS rule FROM policies WHERE policy_number IS NULL
      UNION ALL SELECT 'policy_number', 'notEmpty' FROM policies WHERE policy_number IS NULL OR trim(policy_number) = ''
      UNION ALL SELECT 'driver_age', 'notNull' FROM policies WHERE driver_age IS NULL
      UNION ALL SELECT 'driver_age', 'rangeCheck' FROM policies WHERE driver_age < 18
      UNION ALL SELECT 'driver_age', 'rangeCheck' FROM policies WHERE driver_age > 100
    ) t GROUP BY field, rule
    """,
)
def reject_details(spark, sf_dir):
    """Every failing rule, two rules of one kind on a field included."""
    rules = [
        RULES[0],
        {
            "field": "driver_age",
            "validations": [
                "notNull",
                {"type": "rangeCheck", "params": {"min": 18}},
                {"type": "rangeCheck", "params": {"max": 100}},
            ],
        },
    ]
    rejects = split(table(spark, sf_dir, "policies"), rules, details=True).rejected
    failures = rejects.select(F.inline("validation_details"))
    return failures.groupBy("field", "rule").agg(F.count(F.lit(1)).alias("n_rows"))


def _rule_query(name: str, field: str, rule, message: str, condition: str, registry: RuleRegistry | None = None):
    """One rule on one field: the key and the message of every failing row."""

    def run(spark, sf_dir):
        rejects = split(
            table(spark, sf_dir, "policies"), [{"field": field, "validations": [rule]}], registry
        ).rejected
        return rejects.select("o_orderkey", F.col(ERRORS)[field].alias("message"))

    text = message.replace("'", "''")
    query(name, f"SELECT o_orderkey, '{text}' AS message FROM policies WHERE {condition}")(run)


def _rule(name: str, **params):
    return {"type": name, "params": params}


_rule_query("rule_not_null", "policy_number", "notNull", "policy_number cannot be null", "policy_number IS NULL")
_rule_query(
    "rule_not_empty",
    "policy_number",
    "notEmpty",
    "policy_number cannot be empty",
    "policy_number IS NULL OR trim(policy_number) = ''",
)
_rule_query(
    "rule_is_numeric",
    "age_text",
    "isNumeric",
    "age_text must be numeric",
    "age_text IS NOT NULL AND try_cast(age_text AS DOUBLE) IS NULL",
)
_rule_query(
    "rule_range_check",
    "driver_age",
    _rule("rangeCheck", min=18, max=100),
    "driver_age must be between 18 and 100",
    "driver_age < 18 OR driver_age > 100",
)
_rule_query(
    "rule_range_check_text",
    "age_text",
    _rule("rangeCheck", min=20.5),
    "age_text must be between 20.5 and inf",
    "try_cast(age_text AS DOUBLE) < 20.5",
)
_rule_query(
    "rule_range_check_date",
    "policy_start_date",
    _rule("rangeCheck", max="1997-06-30"),
    "policy_start_date must be between -inf and 1997-06-30",
    "policy_start_date > DATE '1997-06-30'",
)
_rule_query(
    "rule_regex",
    "plate_number",
    _rule("regex", pattern="^[A-Z]{3}-[0-9]{3}$"),
    "plate_number does not match required pattern",
    "NOT regexp_matches(plate_number, '^[A-Z]{3}-[0-9]{3}$')",
)
_rule_query(
    "rule_email",
    "email",
    "email",
    "email must be valid email",
    r"NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')",
)
_rule_query(
    "rule_length",
    "policy_number",
    _rule("length", min=1, max=6),
    "policy_number length must be between 1 and 6",
    "length(policy_number) < 1 OR length(policy_number) > 6",
)
_rule_query(
    "rule_in_list",
    "vehicle_type",
    _rule("inList", values=["sedan", "suv", "truck"], error_message="Invalid vehicle type"),
    "Invalid vehicle type",
    "vehicle_type NOT IN ('sedan', 'suv', 'truck')",
)
_rule_query(
    "rule_in_list_typed",
    "driver_age",
    _rule("inList", values=["20", "30", "40", "old"], error_message="unusual age"),
    "unusual age",
    "driver_age NOT IN (20, 30, 40)",
)
_rule_query(
    "rule_custom",
    "premium",
    _rule("custom", expression="{field} >= 1000 AND driver_age < 90"),
    "premium failed custom validation",
    "NOT (premium >= 1000 AND driver_age < 90)",
)


def _starts_with(df, field, params):
    """A user's own validator, built from Spark functions like the others."""
    bad = ~F.startswith(F.col(field), F.lit(params["prefix"]))
    return F.when(bad, F.lit(f"{field} must start with {params['prefix']}"))


_registry = RuleRegistry()
_registry.register("starts_with", _starts_with)
_rule_query(
    "rule_custom_registered",
    "plate_number",
    _rule("starts_with", prefix="ABC"),
    "plate_number must start with ABC",
    "NOT starts_with(plate_number, 'ABC')",
    _registry,
)


@query("rule_none", "SELECT count(*) AS n_valid, CAST(0 AS BIGINT) AS n_rejected FROM policies")
def rule_none(spark, sf_dir):
    annotated = annotate(table(spark, sf_dir, "policies"), [])
    return annotated.agg(
        F.count_if(F.col(VALID_FLAG)).alias("n_valid"), F.count_if(F.size(ERRORS) > 0).alias("n_rejected")
    )


SUMMARY_SQL = f"""
SELECT total_records, valid_records, total_records - valid_records AS invalid_records,
  CASE WHEN total_records > 0 THEN CAST(valid_records AS DOUBLE) / total_records * 100 END AS valid_percentage
FROM (SELECT count(*) AS total_records, count(*) FILTER (WHERE {ALL_NULL_SQL}) AS valid_records
      FROM ({ANNOTATED_SQL}) t) s
"""


@query("quality_summary", SUMMARY_SQL)
def quality_summary(spark, sf_dir):
    return quality.summary(mark(table(spark, sf_dir, "policies"), RULES))


@query(
    "quality_gate",
    f"SELECT 'min_valid_record_percentage' AS name, valid_percentage AS value, "
    f"CAST(80 AS DOUBLE) AS gate_limit, valid_percentage >= 80 AS passed FROM ({SUMMARY_SQL}) g",
)
def quality_gate(spark, sf_dir):
    measured = quality_summary(spark, sf_dir).first().asDict()
    gate = quality.min_valid_gate(measured, 80)
    row = (gate.name, gate.value, float(gate.limit), gate.passed)
    return spark.createDataFrame([row], "name string, value double, gate_limit double, passed boolean")


@query(
    "duplicate_percentage",
    """
    SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS distinct_keys,
      CAST(sum(n) - count(*) AS BIGINT) AS duplicate_records,
      CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100 AS duplicate_percentage
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) t
    """,
)
def duplicate_percentage(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
