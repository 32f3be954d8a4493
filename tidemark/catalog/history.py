"""Slowly changing dimensions.

Version 1 of the orders is every order but the urgent pending ones. Version 2 changes
the status of high-priority orders, lacks the finished low-priority ones and has the
urgent pending ones as new. A third run brings the removed orders back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.operators import history, joins, stored
from tidemark.session import new_shared_path, shuffle_partitions
from tidemark.sources.stored import StoredTable

KEY, CHECKED = ["o_orderkey"], ["o_orderstatus"]
RUN_1, RUN_2, RUN_3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)

VERSIONS_SQL = """
    v1 AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')),
    v2 AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' THEN 'P' ELSE o_orderstatus END AS o_orderstatus
           FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')),
    v3 AS (SELECT o_orderkey, o_orderstatus FROM v2
           UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
"""


def history_sql(hard_deletes: bool) -> str:
    """Common table expressions up to ``h2``, the history after the second run."""
    deleted = "WHEN v2.o_orderkey IS NULL THEN TIMESTAMP '2024-02-01'" if hard_deletes else ""
    return f"""
    {VERSIONS_SQL},
    h1 AS (SELECT o_orderkey, o_orderstatus, TIMESTAMP '2024-01-01' AS dbt_valid_from FROM v1),
    h2 AS (
        SELECT h1.*, CASE WHEN v2.o_orderstatus IS DISTINCT FROM h1.o_orderstatus AND v2.o_orderkey IS NOT NULL
                     THEN TIMESTAMP '2024-02-01' {deleted} END AS dbt_valid_to
        FROM h1 LEFT JOIN v2 USING (o_orderkey)
        UNION ALL
        SELECT v2.o_orderkey, v2.o_orderstatus, TIMESTAMP '2024-02-01', NULL
        FROM v2 LEFT JOIN h1 USING (o_orderkey)
        WHERE h1.o_orderkey IS NULL OR h1.o_orderstatus <> v2.o_orderstatus)
    """


SCD_ID_SQL = """md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(dbt_valid_from AS VARCHAR)) AS dbt_scd_id,
    dbt_valid_from AS dbt_updated_at"""


def versions(t):
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    changed = F.when((priority == "2-HIGH") & (status != "P"), F.lit("P")).otherwise(status)
    gone = (priority == "5-LOW") & (status == "F")
    first = orders.where(~((priority == "1-URGENT") & (status == "P")))
    second = orders.where(~gone).withColumn("o_orderstatus", changed)
    third = second.unionByName(orders.where(gone))
    return [v.select("o_orderkey", "o_orderstatus") for v in (first, second, third)]


def after_second_run(t, hard_deletes: bool = True):
    first, second, _ = versions(t)
    stored = history.first_snapshot(first, KEY, history.instant(RUN_1))
    return history.scd2_check(stored, second, KEY, CHECKED, RUN_2, hard_deletes)


@query("i6_scd2_check", f"WITH {history_sql(False)} SELECT *, {SCD_ID_SQL} FROM h2")
def scd2_check(t):
    return after_second_run(t, hard_deletes=False)


@query("i8_scd2_hard_deletes", f"WITH {history_sql(True)} SELECT *, {SCD_ID_SQL} FROM h2")
def scd2_hard_deletes(t):
    return after_second_run(t)


REAPPEARANCE_SQL = f"""
    WITH {history_sql(True)}, h3 AS (
        SELECT * FROM h2 WHERE dbt_valid_to IS NOT NULL
        UNION ALL SELECT h.o_orderkey, h.o_orderstatus, h.dbt_valid_from,
            CASE WHEN v3.o_orderkey IS NULL OR v3.o_orderstatus <> h.o_orderstatus THEN TIMESTAMP '2024-03-01' END
        FROM h2 h LEFT JOIN v3 USING (o_orderkey) WHERE h.dbt_valid_to IS NULL
        UNION ALL SELECT v3.o_orderkey, v3.o_orderstatus, TIMESTAMP '2024-03-01', NULL FROM v3
        LEFT JOIN (SELECT * FROM h2 WHERE dbt_valid_to IS NULL) h USING (o_orderkey)
        WHERE h.o_orderkey IS NULL OR v3.o_orderstatus <> h.o_orderstatus)
    SELECT *, {SCD_ID_SQL} FROM h3
    """


@query("i8_scd2_reappearance", REAPPEARANCE_SQL)
def scd2_reappearance(t):
    third = versions(t)[2]
    return history.scd2_check(after_second_run(t), third, KEY, CHECKED, RUN_3)


def stored_runs(t, *runs):
    """A stored history of the orders after full extracts at their times, hard deletes or not."""
    table = StoredTable(t.spark, new_shared_path(t.spark, "orders_history"), KEY, shuffle_partitions(t.spark))
    for extract, now, hard_deletes in runs:
        stored.scd2_check_stored(table, extract, CHECKED, now, hard_deletes)
    return table.read()


@query("i6_scd2_stored", f"WITH {history_sql(False)} SELECT *, {SCD_ID_SQL} FROM h2")
def scd2_stored(t):
    first, second, _ = versions(t)
    return stored_runs(t, (first, RUN_1, False), (second, RUN_2, False))


@query("i8_scd2_stored_reappearance", REAPPEARANCE_SQL)
def scd2_stored_reappearance(t):
    first, second, third = versions(t)
    return stored_runs(t, (first, RUN_1, True), (second, RUN_2, True), (third, RUN_3, True))


TIMESTAMP_SQL = """
    WITH c AS (
        SELECT user_id, max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-10') AS t1,
               arg_max(value, (ts, event_id)) FILTER (WHERE ts < TIMESTAMP '2024-01-10') AS v1,
               max(ts) AS t2, arg_max(value, (ts, event_id)) AS v2 FROM events GROUP BY user_id),
    h AS (
        SELECT user_id, t1 AS ts, v1 AS value, t1 AS dbt_valid_from, CASE WHEN t2 > t1 THEN t2 END AS dbt_valid_to
        FROM c WHERE t1 IS NOT NULL
        UNION ALL SELECT user_id, t2, v2, t2, NULL FROM c WHERE t1 IS NULL OR t2 > t1)
    SELECT user_id, value, ts, dbt_valid_from, dbt_valid_to, dbt_valid_from AS dbt_updated_at FROM h
    """


def latest_events(t):
    """The last event per user before a day, and of all."""
    from tidemark.operators.aggregates import last_values

    events = t("events")
    columns = (["user_id"], ["ts", "event_id"], ["ts", "value"])
    early = events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    return last_values(early, *columns), last_values(events, *columns)


@query("i7_scd2_timestamp_stored", TIMESTAMP_SQL)
def scd2_timestamp_stored(t):
    table = StoredTable(t.spark, new_shared_path(t.spark, "users_history"), ["user_id"], shuffle_partitions(t.spark))
    for extract in latest_events(t):
        stored.scd2_timestamp_stored(table, extract, "ts", RUN_2)
    return table.read().drop("dbt_scd_id")


@query("i7_scd2_timestamp", TIMESTAMP_SQL)
def scd2_timestamp(t):
    first, second = latest_events(t)
    stored = history.first_snapshot(first, ["user_id"], F.col("ts"))
    merged = history.scd2_timestamp(stored, second, ["user_id"], "ts", RUN_2)
    # The id hashes the text of a time with microseconds, which engines write differently.
    return merged.drop("dbt_scd_id")


@query(
    "j5_open_row_join",
    f"""
    WITH {history_sql(True)}
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, h.o_orderstatus, h.dbt_valid_from
    FROM lineitem l LEFT JOIN h2 h ON l.l_orderkey = h.o_orderkey AND h.dbt_valid_to IS NULL
    """,
)
def open_row_join(t):
    current = history.open_rows(after_second_run(t)).select("o_orderkey", "o_orderstatus", "dbt_valid_from")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_join(lines, current, [("l_orderkey", "o_orderkey")])
