"""Dedupe, joins, unions, aggregates, pivots and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import relational, windows
from recordflow.plans.staging import StagingArea
from workload.registry import query, table

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dedupe_subset",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey,
      l_extendedprice, l_shipdate) AS n FROM lineitem) t WHERE n = 1
    """,
)
def dedupe_subset(spark, sf_dir):
    """The first row per key in a stated order."""
    order = [{"column": "l_partkey", "desc": True}, "l_suppkey", "l_extendedprice", "l_shipdate"]
    kept = relational.deduplicate(table(spark, sf_dir, "lineitem"), {"subset": LINE_KEY, "orderBy": order})
    return kept.select(*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query("dedupe_any", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_any(spark, sf_dir):
    """Any row per key; only the key is the same in every run."""
    return relational.deduplicate(table(spark, sf_dir, "lineitem"), {"subset": LINE_KEY}).select(*LINE_KEY)


@query("dedupe_all", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def dedupe_all(spark, sf_dir):
    return relational.deduplicate(table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey"), {})


CUSTOMER_KEY = [{"left": "o_custkey", "right": "c_custkey"}]
ORDER_SQL = "o.o_orderkey, o.o_custkey, o.o_orderstatus"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def _customers(spark, sf_dir):
    """All customers under keys of which half fit no order."""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey * 2 AS c_custkey", "c_nationkey", "c_mktsegment")


CUSTOMERS_SQL = "(SELECT c_custkey * 2 AS c_custkey, c_nationkey, c_mktsegment FROM customer)"


def _join_query(name: str, how: str, oracle: str):
    def run(spark, sf_dir):
        return relational.join(_orders(spark, sf_dir), _customers(spark, sf_dir), {"on": CUSTOMER_KEY, "how": how})

    query(name, oracle)(run)


for _how in ("inner", "left", "right"):
    _join_query(
        f"join_{_how}",
        _how,
        f"SELECT {ORDER_SQL}, c.* FROM orders o {_how.upper()} JOIN {CUSTOMERS_SQL} c ON o.o_custkey = c.c_custkey",
    )
_join_query("join_semi", "semi", f"SELECT {ORDER_SQL} FROM orders o SEMI JOIN {CUSTOMERS_SQL} c ON o.o_custkey = c.c_custkey")
_join_query("join_anti", "anti", f"SELECT {ORDER_SQL} FROM orders o ANTI JOIN {CUSTOMERS_SQL} c ON o.o_custkey = c.c_custkey")

FULL_SQL = """
SELECT coalesce(a.k, b.k) AS k, a.c_name, a.c_acctbal AS balance, b.s_name, b.s_acctbal AS balance_right
FROM (SELECT c_custkey AS k, * FROM customer) a
FULL JOIN (SELECT s_suppkey * 20 AS k, * FROM supplier) b ON a.k = b.k
"""


def _full_join(spark, sf_dir, **params):
    """A shared key comes out once; the other shared name gets a suffix."""
    left = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name", "c_acctbal AS balance")
    right = table(spark, sf_dir, "supplier").selectExpr("s_suppkey * 20 AS k", "s_name", "s_acctbal AS balance")
    return relational.join(left, right, {"on": ["k"], "how": "full", **params}, look_for_skew=True)


@query("join_full", FULL_SQL)
def join_full(spark, sf_dir):
    return _full_join(spark, sf_dir)


@query("join_full_skew_safe", FULL_SQL)
def join_full_skew_safe(spark, sf_dir):
    """The form used when a large side has a hot key: an inner join and two anti joins."""
    return _full_join(spark, sf_dir, hotRows=0)


@query(
    "join_full_null_keys",
    """
    SELECT coalesce(a.policy_number, b.policy_number) AS policy_number, a.o_orderkey, b.o_orderkey AS o_orderkey_right,
      b.premium
    FROM (SELECT * FROM policies WHERE o_orderkey % 2 = 1) a
    FULL JOIN (SELECT * FROM policies WHERE o_orderkey % 2 = 0) b
      ON a.policy_number = b.policy_number AND a.vehicle_type = b.vehicle_type
    """,
)
def join_full_null_keys(spark, sf_dir):
    """Odd policies with even ones; those without a number match nothing and go through no shuffle."""
    policies = table(spark, sf_dir, "policies")
    left = policies.filter("o_orderkey % 2 = 1").select("policy_number", "vehicle_type", "o_orderkey")
    right = policies.filter("o_orderkey % 2 = 0").select("policy_number", "vehicle_type", "o_orderkey", "premium")
    params = {"on": ["policy_number", "vehicle_type"], "how": "full"}
    return relational.join(left, right, params).drop("vehicle_type")


@query(
    "join_left_skew_safe",
    f"SELECT c.*, {ORDER_SQL} FROM {CUSTOMERS_SQL} c LEFT JOIN orders o ON o.o_custkey = c.c_custkey",
)
def join_left_skew_safe(spark, sf_dir):
    """Customers with their orders, some customers having far more orders than others."""
    params = {"on": [{"left": "c_custkey", "right": "o_custkey"}], "how": "left", "hotRows": 1}
    return relational.join(_customers(spark, sf_dir), _orders(spark, sf_dir), params, look_for_skew=True)


@query(
    "join_condition",
    """
    SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_acctbal
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice > 20 * c.c_acctbal
    """,
)
def join_condition(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return relational.join(
        orders, customer, {"on": CUSTOMER_KEY, "condition": "l.o_totalprice > 20 * r.c_acctbal"}
    )


@query(
    "join_broadcast",
    """
    SELECT c.c_custkey, c.c_nationkey, n.n_nationkey, n.n_name, n.n_regionkey
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
)
def join_broadcast(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    on = [{"left": "c_nationkey", "right": "n_nationkey"}]
    return relational.join(customer, table(spark, sf_dir, "nation"), {"on": on, "broadcast": True})


def _parties(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return customer, supplier


@query(
    "union_by_name",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def union_by_name(spark, sf_dir):
    customer, supplier = _parties(spark, sf_dir)
    return relational.union([customer.drop("segment"), supplier], {})


@query(
    "union_missing",
    "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier",
)
def union_missing(spark, sf_dir):
    return relational.union(list(_parties(spark, sf_dir)), {"allowMissing": True})


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(spark, sf_dir):
    return relational.union([frame.select("nation") for frame in _parties(spark, sf_dir)], {"distinct": True})


@query(
    "agg_all",
    """
    SELECT vehicle_type, coverage_type, CAST(sum(CAST(premium AS DECIMAL(18,3))) AS DECIMAL(28,3)) AS total_premium,
      round(avg(driver_age), 6) AS avg_age, count(policy_number) AS policy_count,
      min(policy_start_date) AS min_policy_start_date, max(plate_number) AS last_plate
    FROM policies GROUP BY vehicle_type, coverage_type
    """,
)
def agg_all(spark, sf_dir):
    """All five functions; the sum is over exact decimals, so that row order cannot change it."""
    policies = table(spark, sf_dir, "policies").withColumn("premium", F.col("premium").cast("decimal(18,3)"))
    params = {
        "groupBy": ["vehicle_type", "coverage_type"],
        "aggregations": [
            {"function": "sum", "column": "premium", "alias": "total_premium"},
            {"function": "avg", "column": "driver_age", "alias": "avg_age"},
            {"function": "count", "column": "policy_number", "alias": "policy_count"},
            {"function": "min", "column": "policy_start_date"},
            {"function": "max", "column": "plate_number", "alias": "last_plate"},
        ],
    }
    return relational.aggregate(policies, params).withColumn("avg_age", F.round("avg_age", 6))


@query(
    "agg_lineitem",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_l_quantity, min(l_extendedprice) AS min_price,
      max(l_extendedprice) AS max_price, count(*) AS n_lines
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def agg_lineitem(spark, sf_dir):
    params = {
        "groupBy": ["l_returnflag", "l_linestatus"],
        "aggregations": [
            {"function": "sum", "column": "l_quantity"},
            {"function": "min", "column": "l_extendedprice", "alias": "min_price"},
            {"function": "max", "column": "l_extendedprice", "alias": "max_price"},
            {"function": "count", "column": "*", "alias": "n_lines"},
        ],
    }
    return relational.aggregate(table(spark, sf_dir, "lineitem"), params)


@query(
    "pivot_first",
    """
    SELECT vehicle_type, max(n) FILTER (WHERE coverage_type = 'comprehensive') AS comprehensive,
      max(n) FILTER (WHERE coverage_type = 'third_party') AS third_party,
      max(n) FILTER (WHERE coverage_type = 'collision') AS collision,
      max(n) FILTER (WHERE coverage_type IS NULL) AS "null"
    FROM (SELECT vehicle_type, coverage_type, count(*) AS n FROM policies GROUP BY 1, 2) t GROUP BY vehicle_type
    """,
)
def pivot_first(spark, sf_dir):
    """One row per cell, so that the first value is the only one; the pivot values are looked up."""
    counts = relational.aggregate(
        table(spark, sf_dir, "policies"),
        {
            "groupBy": ["vehicle_type", "coverage_type"],
            "aggregations": [{"function": "count", "column": "*", "alias": "n"}],
        },
    )
    return relational.pivot(
        counts, {"groupBy": ["vehicle_type"], "pivotColumn": "coverage_type", "valueColumn": "n"}
    )


@query(
    "pivot_latest",
    """
    SELECT user_id, first(value ORDER BY ts DESC, event_id) FILTER (WHERE event_type = 'click') AS click,
      first(value ORDER BY ts DESC, event_id) FILTER (WHERE event_type = 'purchase') AS purchase
    FROM events GROUP BY user_id
    """,
)
def pivot_latest(spark, sf_dir):
    """What each user's last event of a kind was worth."""
    latest = [{"column": "ts", "desc": True}, "event_id"]
    params = {"groupBy": ["user_id"], "pivotColumn": "event_type", "valueColumn": "value", "values": ["click", "purchase"], "orderBy": latest}
    return relational.pivot(table(spark, sf_dir, "events"), params)


@query(
    "pivot_sum",
    """
    SELECT l_returnflag, sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS "F",
      sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY l_returnflag
    """,
)
def pivot_sum(spark, sf_dir):
    params = {
        "groupBy": ["l_returnflag"],
        "pivotColumn": "l_linestatus",
        "valueColumn": "l_quantity",
        "values": ["F", "O"],
        "aggregate": "sum",
    }
    return relational.pivot(table(spark, sf_dir, "lineitem"), params)


WINDOW_SQL = {
    "row_number": "row_number() OVER ({spec})",
    "rank": "rank() OVER ({spec})",
    "dense_rank": "dense_rank() OVER ({spec})",
    "lag": "lag(value, 2) OVER ({spec})",
    "lead": "lead(value) OVER ({spec})",
}


def _window_query(name: str, function: str, keys: list[str], order: list, order_sql: str, **extra):
    params = {"partitionBy": keys, "orderBy": order, "function": function, "alias": "answer", **extra}
    if function == "lag":
        params["offset"] = 2
    if function in ("lag", "lead"):
        params["column"] = "value"
    spec = f"PARTITION BY {', '.join(keys)} ORDER BY {order_sql}"

    def run(spark, sf_dir):
        answered = windows.window(table(spark, sf_dir, "events"), params, StagingArea(spark))
        return answered.select("event_id", "user_id", "event_type", "ts", "answer")

    answer = WINDOW_SQL[function].format(spec=spec)
    query(name, f"SELECT event_id, user_id, event_type, ts, {answer} AS answer FROM events")(run)


# Ranks get an order with ties, the others an order without.
TIED, TIED_SQL = ["value"], "value ASC NULLS FIRST"
UNIQUE, UNIQUE_SQL = [{"column": "ts", "desc": True}, "event_id"], "ts DESC NULLS LAST, event_id"
for _function in WINDOW_SQL:
    _tied = _function in ("rank", "dense_rank")
    _order, _order_sql = (TIED, TIED_SQL) if _tied else (UNIQUE, UNIQUE_SQL)
    _window_query(f"win_{_function}", _function, ["user_id"], _order, _order_sql)
    # A few keys hold all rows: the form for hot keys, with its threshold low enough to apply here.
    _window_query(
        f"win_hot_{_function}", _function, ["event_type"], _order, _order_sql, hotRows=1000
    )
