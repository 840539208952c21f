"""Field functions and the other row-wise steps."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from recordflow.functions.fields import FieldRegistry
from recordflow.operators import projections
from workload.registry import query, table

RUN_TIME = datetime.datetime(2025, 11, 19, 10, 21, 42, tzinfo=datetime.timezone.utc)


def _field_query(name: str, fields: list[dict], oracle: str | None, base: str = "policies", key: str = "o_orderkey"):
    """Fields added to the whole table; the key and the new fields are returned."""

    def run(spark, sf_dir):
        added = projections.add_fields(table(spark, sf_dir, base), {"addFields": fields}, run_time=RUN_TIME)
        return added.select(key, *dict.fromkeys(field["name"] for field in fields))

    query(name, f"SELECT {key}, {oracle} FROM {base}" if oracle else None)(run)


def _field(name: str, function: str, **params) -> dict:
    return {"name": name, "function": function, **params}


HASHED = ["policy_number", "plate_number", "driver_age"]
JOINED_SQL = "concat_ws('||', policy_number, plate_number, CAST(driver_age AS VARCHAR))"

_field_query(
    "field_hash_md5", [_field("record_hash", "hash", columns=HASHED, algorithm="md5")], f"md5({JOINED_SQL}) AS record_hash"
)
_field_query(
    "field_hash_sha1",
    [_field("record_hash", "hash", columns=HASHED, algorithm="sha1")],
    f"sha1({JOINED_SQL}) AS record_hash",
)
_field_query(
    "field_hash_sha256", [_field("record_hash", "hash", columns=HASHED)], f"sha256({JOINED_SQL}) AS record_hash"
)


@query(
    "field_hash_sha512",
    f"""
    SELECT count(*) AS n_rows, count(DISTINCT {JOINED_SQL}) AS n_digests, 128 AS shortest, 128 AS longest, count(*) AS n_hex
    FROM policies
    """,
)
def field_hash_sha512(spark, sf_dir):
    """What can be said of the digests without another SHA-512: as many as texts, and 128 hexadecimal digits each."""
    fields = [_field("record_hash", "hash", columns=HASHED, algorithm="sha512")]
    hashed = projections.add_fields(table(spark, sf_dir, "policies"), {"addFields": fields})
    return hashed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("record_hash").alias("n_digests"),
        F.min(F.length("record_hash")).alias("shortest"),
        F.max(F.length("record_hash")).alias("longest"),
        F.count_if(F.col("record_hash").rlike("^[0-9a-f]+$")).alias("n_hex"),
    )


_field_query(
    "field_hash_null_token",
    [_field("record_hash", "hash", columns=HASHED, nullToken="<null>")],
    "sha256(concat_ws('||', coalesce(policy_number, '<null>'), coalesce(plate_number, '<null>'), "
    "coalesce(CAST(driver_age AS VARCHAR), '<null>'))) AS record_hash",
)
_field_query(
    "field_concat",
    [
        _field("joined", "concat", columns=["policy_number", "plate_number"]),
        _field("separated", "concat", columns=["policy_number", "plate_number", "driver_age"], separator="/"),
    ],
    "policy_number || plate_number AS joined, "
    "concat_ws('/', policy_number, plate_number, CAST(driver_age AS VARCHAR)) AS separated",
)
_field_query(
    "field_substring",
    [
        _field("middle", "substring", column="email", start=2, length=4),
        _field("rest", "substring", column="email", start=5),
        _field("tail", "substring", column="email", start=-7),
        _field("whole", "substring", column="email", length=0),
    ],
    "substring(email, 2, 4) AS middle, substring(email, 5) AS rest, right(email, 7) AS tail, email AS whole",
)
_field_query(
    "field_case",
    [_field("big", "upper", column="vehicle_type"), _field("small", "lower", column="plate_number")],
    "upper(vehicle_type) AS big, lower(plate_number) AS small",
)
_field_query(
    "field_trim",
    [
        _field("padded", "expr", expression="concat('  ', vehicle_type, ' ')"),
        _field("trimmed", "trim", column="padded"),
    ],
    "concat('  ', vehicle_type, ' ') AS padded, vehicle_type AS trimmed",
)
_field_query(
    "field_cast",
    [
        _field("age", "cast", column="age_text", type="int"),
        _field("start_text", "cast", column="policy_start_date", type="string"),
        _field("price", "cast", column="premium", type="decimal(18,3)"),
    ],
    "try_cast(age_text AS INTEGER) AS age, CAST(policy_start_date AS VARCHAR) AS start_text, "
    "CAST(premium AS DECIMAL(18,3)) AS price",
)
_field_query(
    "field_coalesce",
    [_field("known", "coalesce", columns=["policy_number", "plate_number", "email"])],
    "coalesce(policy_number, plate_number, email) AS known",
)
_field_query(
    "field_when",
    [
        _field("started", "when", condition="policy_start_date < '1995-01-01'", then="early", otherwise="late"),
        _field("senior", "when", condition="driver_age > 80", then=1),
        _field("mixed", "when", condition="driver_age > 80", then=1, otherwise="no"),
    ],
    "CASE WHEN policy_start_date < DATE '1995-01-01' THEN 'early' ELSE 'late' END AS started, "
    "CASE WHEN driver_age > 80 THEN 1 END AS senior, CASE WHEN driver_age > 80 THEN '1' ELSE 'no' END AS mixed",
)
_field_query(
    "field_date_parts",
    [
        _field("y", "year", column="policy_start_date"),
        _field("m", "month", column="policy_start_date"),
        _field("d", "day", column="policy_start_date"),
    ],
    "CAST(year(policy_start_date) AS INTEGER) AS y, CAST(month(policy_start_date) AS INTEGER) AS m, "
    "CAST(day(policy_start_date) AS INTEGER) AS d",
)
_field_query(
    "field_datediff",
    [_field("days", "datediff", start_date="policy_start_date", end_date="policy_end_date")],
    "CAST(date_diff('day', policy_start_date, policy_end_date) AS INTEGER) AS days",
)
_field_query(
    "field_expr",
    [_field("discounted", "expr", expression="premium * 0.5 + coalesce(driver_age, 0)")],
    "premium * CAST(0.5 AS DOUBLE) + coalesce(driver_age, 0) AS discounted",
)
_field_query(
    "field_lookup",
    [
        _field("wheels", "lookup", column="vehicle_type", mapping={"sedan": 4, "motorcycle": 2}, default=0),
        _field("cover", "lookup", column="coverage_type", mapping={"comprehensive": "full", "collision": "part"}),
        _field("age_name", "lookup", column="driver_age", mapping={"20": "twenty", "30": "thirty", "x": "never"}),
    ],
    "CASE vehicle_type WHEN 'sedan' THEN 4 WHEN 'motorcycle' THEN 2 ELSE 0 END AS wheels, "
    "CASE coverage_type WHEN 'comprehensive' THEN 'full' WHEN 'collision' THEN 'part' END AS cover, "
    "CASE driver_age WHEN 20 THEN 'twenty' WHEN 30 THEN 'thirty' END AS age_name",
)
_field_query(
    "field_lookup_large",
    [
        _field(
            "customer_group",
            "lookup",
            column="o_custkey",
            mapping={str(key): f"g{key % 7}" for key in range(1200)},
            default="none",
        ),
        _field(
            "rank", "lookup", column="o_custkey", mapping={str(key): None if key % 5 == 0 else key % 3 for key in range(1200)}, default=9
        ),
        _field(
            "share", "lookup", column="o_custkey", mapping={str(key): 0.5 if key % 2 else 1 for key in range(1001)}
        ),
    ],
    "CASE WHEN o_custkey < 1200 THEN 'g' || CAST(o_custkey % 7 AS VARCHAR) ELSE 'none' END AS customer_group, "
    "CASE WHEN o_custkey >= 1200 THEN 9 WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS INTEGER) END AS rank, "
    "CASE WHEN o_custkey > 1000 THEN NULL WHEN o_custkey % 2 = 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS share",
    base="orders",
)
_field_query(
    "field_literal",
    [_field("flow_version", "literal", value="1.0.0"), _field("seven", "literal", value=7)],
    "'1.0.0' AS flow_version, 7 AS seven",
)
_field_query(
    "field_dependent",
    [
        _field("plate_number", "upper", column="plate_number"),
        _field("label", "concat", columns=["plate_number", "vehicle_type"], separator=":"),
        _field("label_length", "expr", expression="length(label)"),
        _field("label", "lower", column="label"),
    ],
    "upper(plate_number) AS plate_number, lower(concat_ws(':', upper(plate_number), vehicle_type)) AS label, "
    "CAST(length(concat_ws(':', upper(plate_number), vehicle_type)) AS INTEGER) AS label_length",
)


@query("field_uuid", "SELECT count(*) AS n_rows, count(*) AS n_distinct, count(*) AS n_well_formed FROM policies")
def field_uuid(spark, sf_dir):
    added = projections.add_fields(
        table(spark, sf_dir, "policies"), {"addFields": [_field("record_id", "uuid")]}
    ).select("record_id")
    version_4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    per_id = added.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.when(F.col("record_id").rlike(version_4), F.col("n"))).alias("n_well_formed"),
    )


@query(
    "field_run_time",
    "SELECT count(*) AS n_rows, TIMESTAMP '2025-11-19 10:21:42' AS first_time, "
    "TIMESTAMP '2025-11-19 10:21:42' AS last_time, DATE '2025-11-19' AS run_date FROM policies",
)
def field_run_time(spark, sf_dir):
    """The run's timestamp and date are one value for all rows."""
    fields = [_field("at", "current_timestamp"), _field("on", "current_date")]
    added = projections.add_fields(table(spark, sf_dir, "policies"), {"addFields": fields}, run_time=RUN_TIME)
    return added.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("at").cast("timestamp_ntz").alias("first_time"),
        F.max("at").cast("timestamp_ntz").alias("last_time"),
        F.max("on").alias("run_date"),
    )


def _initials(df, params):
    """A user's own field function."""
    return F.concat(*[F.substring(F.col(name), 1, 1) for name in params["columns"]])


@query(
    "field_custom_registered",
    "SELECT o_orderkey, substring(vehicle_type, 1, 1) || substring(coverage_type, 1, 1) AS initials FROM policies",
)
def field_custom_registered(spark, sf_dir):
    registry = FieldRegistry()
    registry.register("initials", _initials)
    fields = [_field("initials", "initials", columns=["vehicle_type", "coverage_type"])]
    added = projections.add_fields(table(spark, sf_dir, "policies"), {"addFields": fields}, registry)
    return added.select("o_orderkey", "initials")


@query(
    "step_add_fields",
    "SELECT o_orderkey, lower(vehicle_type) || '/' || coverage_type AS product, "
    "CASE WHEN premium > 20000 THEN 'large' ELSE 'small' END AS premium_class, CAST(year(policy_start_date) AS INTEGER) AS cohort, "
    "md5(concat_ws('||', vehicle_type, coverage_type)) AS product_key FROM policies",
)
def step_add_fields(spark, sf_dir):
    fields = [
        _field("kind", "lower", column="vehicle_type"),
        _field("slash", "literal", value="/"),
        _field("product", "concat", columns=["kind", "slash", "coverage_type"]),
        _field("premium_class", "when", condition="premium > 20000", then="large", otherwise="small"),
        _field("cohort", "year", column="policy_start_date"),
        _field("product_key", "hash", columns=["vehicle_type", "coverage_type"], algorithm="md5"),
    ]
    added = projections.add_fields(table(spark, sf_dir, "policies"), {"addFields": fields})
    return added.select("o_orderkey", "product", "premium_class", "cohort", "product_key")


@query(
    "step_rename",
    "SELECT r_regionkey AS id, r_name AS region_label FROM region",
)
def step_rename(spark, sf_dir):
    """Renames apply one after another: r_name becomes title, then region_label."""
    mapping = {"r_name": "title", "r_regionkey": "id", "title": "region_label", "absent": "ignored"}
    return projections.rename_columns(
        table(spark, sf_dir, "region"), {"mapping": mapping, "onMissing": "skip"}
    )


@query("step_drop", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def step_drop(spark, sf_dir):
    return projections.drop_columns(table(spark, sf_dir, "customer"), {"columns": ["c_name", "c_acctbal"]})


@query("step_select", "SELECT c_mktsegment, c_custkey FROM customer")
def step_select(spark, sf_dir):
    return projections.select_columns(table(spark, sf_dir, "customer"), {"columns": ["c_mktsegment", "c_custkey"]})


@query(
    "step_filter",
    "SELECT o_orderkey, driver_age, premium FROM policies WHERE driver_age > 40 AND vehicle_type = 'suv'",
)
def step_filter(spark, sf_dir):
    kept = projections.filter_rows(
        table(spark, sf_dir, "policies"), {"condition": "driver_age > 40 AND vehicle_type = 'suv'"}
    )
    return kept.select("o_orderkey", "driver_age", "premium")
