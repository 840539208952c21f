"""Joins that meet by ranges instead of equal keys."""

from __future__ import annotations

from recordflow.operators import relational
from workload.registry import query, table

WINDOWS_SQL = """
SELECT o_orderpriority AS priority, extract(year FROM o_orderdate) * 12 + extract(month FROM o_orderdate) AS month,
 min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM {orders} GROUP BY 1, 2
"""
BANDS_SQL = "SELECT p_size AS band, min(p_retailprice) AS low, min(p_retailprice) + p_size / 4.0 AS high FROM {part} GROUP BY p_size"
SESSIONS_SQL = """
SELECT user_id, event_type, min(ts) AS began, max(ts) AS ended, count(*) AS n_events
FROM {events} GROUP BY user_id, event_type, CAST(ts AS DATE)
"""


def _windows(spark, sf_dir):
    return spark.sql(WINDOWS_SQL, orders=table(spark, sf_dir, "orders"))


def _bands(spark, sf_dir):
    return spark.sql(BANDS_SQL, part=table(spark, sf_dir, "part"))


@query(
    "join_range",
    f"""
    SELECT o.o_orderkey, w.priority, CAST(w.month AS BIGINT) AS month FROM orders o
    JOIN ({WINDOWS_SQL.format(orders="orders")}) w ON o.o_orderdate BETWEEN w.first_order AND w.last_order
    """,
)
def join_range(spark, sf_dir):
    """Orders within the months in which orders of each priority came."""
    between = {"value": "o_orderdate", "low": "first_order", "high": "last_order"}
    joined = relational.join(table(spark, sf_dir, "orders"), _windows(spark, sf_dir), {"between": between}, look_for_skew=True)
    return joined.selectExpr("o_orderkey", "priority", "CAST(month AS BIGINT) AS month")


def _band_query(name: str, how: str, oracle: str, columns: list[str], **params):
    def run(spark, sf_dir):
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
        between = {"value": "c_acctbal", "low": "low", "high": "high", "bounds": "[)"}
        joined = relational.join(customers, _bands(spark, sf_dir), {"between": between, "how": how, **params})
        return joined.select(*columns)

    query(name, oracle)(run)


_BANDS = BANDS_SQL.format(part="part")
_IN_BAND = "c.c_acctbal >= b.low AND c.c_acctbal < b.high"
_BAND_COLUMNS = ["c_custkey", "band", "low"]
_band_query(
    "join_range_left",
    "left",
    f"SELECT c.c_custkey, b.band, b.low FROM customer c LEFT JOIN ({_BANDS}) b ON {_IN_BAND} AND c.c_nationkey <> b.band",
    _BAND_COLUMNS,
    condition="l.c_nationkey <> r.band",
)
_band_query("join_range_full", "full", f"SELECT c.c_custkey, b.band, b.low FROM customer c FULL JOIN ({_BANDS}) b ON {_IN_BAND}", _BAND_COLUMNS)
_band_query("join_range_semi", "semi", f"SELECT c_custkey FROM customer c SEMI JOIN ({_BANDS}) b ON {_IN_BAND}", ["c_custkey"])
_band_query("join_range_anti", "anti", f"SELECT c_custkey FROM customer c ANTI JOIN ({_BANDS}) b ON {_IN_BAND}", ["c_custkey"])


@query(
    "join_overlaps",
    f"""
    WITH s AS ({SESSIONS_SQL.format(events="events")})
    SELECT a.user_id, a.event_type, a.began, b.event_type AS event_type_right, b.began AS began_right, b.n_events AS n_events_right
    FROM s a JOIN s b ON a.user_id = b.user_id AND a.began < b.ended AND b.began < a.ended AND a.event_type < b.event_type
    """,
)
def join_overlaps(spark, sf_dir):
    """Times of a user's day in which two kinds of events went on."""
    sessions = spark.sql(SESSIONS_SQL, events=table(spark, sf_dir, "events"))
    overlaps = {"left": ["began", "ended"], "right": ["began", "ended"], "bounds": "()"}
    params = {"on": ["user_id"], "overlaps": overlaps, "condition": "l.event_type < r.event_type"}
    joined = relational.join(sessions, sessions, params, look_for_skew=True)
    return joined.select("user_id", "event_type", "began", "event_type_right", "began_right", "n_events_right")
