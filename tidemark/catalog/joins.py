"""Joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.text import first_filled
from tidemark.operators import aggregates, joins

FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 30)

# The constant relation of the lookup query.
SEGMENT_CODES = [("BUILDING", 1), ("MACHINERY", 2), ("HOUSEHOLD", 3), ("UNUSED", 4)]


@query(
    "j1_lookup_left_join",
    """
    SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    """,
)
def lookup_left_join(t):
    orders = t("orders").select("o_orderkey", "o_custkey")
    customers = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.lookup_join(orders, customers, [("o_custkey", "c_custkey")])


@query(
    "j2_child_to_root",
    """
    SELECT l.l_partkey, l.l_linenumber, o.o_custkey AS customer FROM lineitem l
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey IS NOT NULL
    """,
)
def child_to_root(t):
    lines = t("lineitem").select("l_partkey", "l_linenumber", F.col("l_orderkey").alias("_dlt_root_id"))
    return joins.join_child(lines, t("orders"), "o_orderkey", "o_custkey", "customer")


@query(
    "j3_star_fanout",
    """
    SELECT c.c_custkey, a.status, b.priority, y.order_year FROM customer c
    LEFT JOIN (SELECT DISTINCT o_custkey, o_orderstatus AS status FROM orders) a ON c.c_custkey = a.o_custkey
    LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority AS priority FROM orders) b ON c.c_custkey = b.o_custkey
    LEFT JOIN (SELECT DISTINCT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS order_year
               FROM orders) y ON c.c_custkey = y.o_custkey
    """,
)
def star_fanout(t):
    orders = t("orders")
    status = orders.select("o_custkey", F.col("o_orderstatus").alias("status")).distinct()
    priority = orders.select("o_custkey", F.col("o_orderpriority").alias("priority")).distinct()
    years = orders.select("o_custkey", F.year("o_orderdate").alias("order_year")).distinct()
    children = {
        "status": (status, "o_custkey", "status"),
        "priority": (priority, "o_custkey", "priority"),
        "order_year": (years, "o_custkey", "order_year"),
    }
    return joins.star_fanout(t("customer"), "c_custkey", children)


HIERARCHY_SQL = """
    WITH v AS (SELECT DISTINCT o_custkey AS k, o_orderpriority AS p FROM orders)
    SELECT a.k AS o_custkey, a.p AS o_orderpriority, b.p AS o_orderpriority2, c.p AS o_orderpriority3,
           d.p AS o_orderpriority4, e.p AS o_orderpriority5, f.p AS o_orderpriority6, g.p AS o_orderpriority7
    FROM v a
    LEFT JOIN v b ON a.k = b.k AND b.p <> a.p
    LEFT JOIN v c ON a.k = c.k AND c.p NOT IN (a.p, b.p)
    LEFT JOIN v d ON a.k = d.k AND d.p NOT IN (a.p, b.p, c.p)
    LEFT JOIN v e ON a.k = e.k AND e.p NOT IN (a.p, b.p, c.p, d.p)
    LEFT JOIN v f ON a.k = f.k AND f.p NOT IN (a.p, b.p, c.p, d.p, e.p)
    LEFT JOIN v g ON a.k = g.k AND g.p NOT IN (a.p, b.p, c.p, d.p, e.p, f.p)
"""


@query("j4_hierarchy", HIERARCHY_SQL)
def hierarchy(t):
    return joins.hierarchy(t("orders"), "o_custkey", "o_orderpriority", depth=7)


@query(
    "j6_date_spine",
    """
    SELECT c.c_custkey, CAST(d.day AS DATE) AS date_col FROM customer c
    CROSS JOIN generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) d(day)
    """,
)
def date_spine(t):
    return joins.date_spine_join(t("customer").select("c_custkey"), F.lit(FIRST_DAY), F.lit(dt.date(2024, 1, 31)))


@query(
    "j7_missing_pairs",
    """
    WITH wanted AS (
        SELECT u.user_id, CAST(d.day AS DATE) AS date_col FROM (SELECT DISTINCT user_id FROM events) u
        CROSS JOIN generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) d(day))
    SELECT w.date_col, w.user_id FROM wanted w LEFT JOIN events e
        ON w.date_col = CAST(e.ts AS DATE) AND w.user_id = e.user_id WHERE e.user_id IS NULL
    """,
)
def missing_pairs(t):
    events = t("events").select("user_id", F.col("ts").cast("date").alias("date_col"))
    users = events.select("user_id").distinct()
    wanted = joins.date_spine_join(users, F.lit(FIRST_DAY), F.lit(LAST_DAY))
    return joins.missing_rows(wanted, events, ["date_col", "user_id"]).select("date_col", "user_id")


@query(
    "j8_fanout_join",
    """
    SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_regionkey
    """,
)
def fanout_join(t):
    nations = t("nation").select("n_regionkey", "n_name")
    return joins.lookup_join(t("customer").select("c_custkey", "c_nationkey"), nations, [("c_nationkey", "n_regionkey")])


@query(
    "j9_aggregate_lookup",
    """
    SELECT c.c_custkey, c.c_name, o.num_orders FROM customer c
    LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS num_orders FROM orders GROUP BY o_custkey) o
        ON c.c_custkey = o.o_custkey
    """,
)
def aggregate_lookup(t):
    counted = F.count("o_orderkey").alias("num_orders")
    return joins.aggregate_lookup(t("customer").select("c_custkey", "c_name"), t("orders"), "c_custkey", "o_custkey", counted)


@query(
    "j10_constant_lookup",
    """
    SELECT c.c_custkey, c.c_mktsegment, v.code FROM customer c
    JOIN (VALUES ('BUILDING', 1), ('MACHINERY', 2), ('HOUSEHOLD', 3), ('UNUSED', 4)) v(segment, code)
        ON c.c_mktsegment = v.segment
    """,
)
def constant_lookup(t):
    customers = t("customer").select("c_custkey", "c_mktsegment")
    return joins.constant_lookup(customers, SEGMENT_CODES, "segment string, code int", ("c_mktsegment", "segment"))


@query(
    "j11_previous_value",
    """
    SELECT e.event_id, e.user_id, e.value, p.last_value, p.last_type FROM events e
    LEFT JOIN (SELECT user_id AS u, arg_max(value, (ts, event_id)) AS last_value, arg_max(event_type, (ts, event_id)) AS last_type
               FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY user_id) p ON e.user_id = p.u
    """,
)
def previous_value(t):
    events = t("events")
    earlier = events.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    last = aggregates.last_values(earlier, ["user_id"], ["ts", "event_id"], ["value", "event_type"])
    stored = last.select(
        F.col("user_id").alias("u"), F.col("value").alias("last_value"), F.col("event_type").alias("last_type")
    )
    return joins.lookup_join(events.select("event_id", "user_id", "value"), stored, [("user_id", "u")])


@query(
    "j12_orphan_keys",
    """
    SELECT l_orderkey, l_suppkey FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
    """,
)
def orphan_keys(t):
    parents = t("orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    return joins.lookup_join(t("lineitem").select("l_orderkey", "l_suppkey"), parents, [("l_orderkey", "o_orderkey")], "left_anti")


@query(
    "s15_fallback_projection",
    """
    SELECT c.c_custkey, COALESCE(NULLIF(n.detail_name, ''), c.c_mktsegment) AS place,
           COALESCE(n.has_detail, FALSE) AS has_detail, NULL::VARCHAR AS region_code
    FROM customer c LEFT JOIN (
        SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN '' ELSE n_name END AS detail_name, TRUE AS has_detail
        FROM nation WHERE n_regionkey < 4) n ON c.c_nationkey = n.n_nationkey
    """,
)
def fallback_projection(t):
    name = F.when(F.col("n_regionkey") == 1, F.lit("")).otherwise(F.col("n_name"))
    details = t("nation").where("n_regionkey < 4").select("n_nationkey", name.alias("detail_name"), F.lit(True).alias("_has"))
    customers = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return joins.lookup_join(customers, details, [("c_nationkey", "n_nationkey")]).select(
        "c_custkey",
        first_filled("detail_name", "c_mktsegment").alias("place"),
        F.coalesce("_has", F.lit(False)).alias("has_detail"),
        F.lit(None).cast("string").alias("region_code"),
    )
