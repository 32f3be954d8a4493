"""Data-quality checks: each query returns the failing rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.joins import HIERARCHY_SQL
from tidemark.operators import joins, quality
from tidemark.operators.quality import RowCheck, TableCheck, UniqueCheck
from tidemark.sources.layouts import layout


@query(
    "q1_not_null",
    "SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL",
)
def not_null(t):
    labels = t("labels").select("doc_id", "quality")
    return quality.not_null(t("documents").select("doc_id", "source").join(labels, "doc_id", "left"), "quality")


@query(
    "q2_unique",
    "SELECT l_orderkey AS unique_field, COUNT(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1",
)
def unique(t):
    return quality.unique(t("lineitem"), "l_orderkey")


@query(
    "q3_accepted_values",
    "SELECT o_orderstatus AS value_field, COUNT(*) AS n_records FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def accepted_values(t):
    return quality.accepted_values(t("orders"), "o_orderstatus", ["F", "O"])


@query(
    "q4_relationships",
    """
    SELECT l_orderkey AS from_field FROM lineitem WHERE l_orderkey IS NOT NULL
    AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')
    """,
)
def relationships(t):
    parents = t("orders").where("o_orderpriority <> '5-LOW'")
    return quality.relationships(t("lineitem"), "l_orderkey", parents, "o_orderkey")


@query(
    "q5_unique_combination",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def unique_combination(t):
    return quality.unique_combination(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q6_between",
    """
    SELECT l_orderkey, l_linenumber, l_discount, 'inclusive' AS kind FROM lineitem WHERE NOT (l_discount >= 0.02 AND l_discount <= 0.08)
    UNION ALL SELECT l_orderkey, l_linenumber, l_discount, 'strict' FROM lineitem WHERE NOT (l_discount > 0.02 AND l_discount < 0.08)
    """,
)
def between(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    loose = quality.between(rows, "l_discount", 0.02, 0.08).withColumn("kind", F.lit("inclusive"))
    return loose.unionByName(quality.between(rows, "l_discount", 0.02, 0.08, strictly=True).withColumn("kind", F.lit("strict")))


@query(
    "q7_expression_is_true",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE NOT (o_orderdate < TIMESTAMP '2000-01-01')",
)
def expression_is_true(t):
    rows = t("orders").select("o_orderkey", "o_orderdate")
    return quality.expression_is_true(rows, F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


@query(
    "q8_freshness",
    """
    SELECT MAX(ts) AS max_loaded_at, date_diff('day', CAST(MAX(ts) AS DATE), DATE '2024-02-04') AS age_days,
           CASE WHEN MAX(ts) < TIMESTAMP '2024-01-30 08:00:00' THEN 'error'
                WHEN MAX(ts) < TIMESTAMP '2024-02-02 08:00:00' THEN 'warn' ELSE 'pass' END AS status FROM events
    """,
)
def freshness(t):
    return quality.freshness(t("events"), "ts", dt.datetime(2024, 2, 4, 8), 2, 5)


@query(
    "q9_schema_contract",
    """
    SELECT 'contract' AS check_name, 'error' AS severity, 2 AS failures
    UNION ALL SELECT 'filled', 'error', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'status', 'warn', COUNT(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
    """,
)
def schema_contract(t):
    orders = t("orders")
    contract = layout(
        "o_orderkey bigint, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string, o_comment string"
    )
    rows = [RowCheck("filled", quality.null_in("o_custkey")), RowCheck("status", F.col("o_orderstatus") == "P", "warn")]
    return quality.run_checks(orders, rows, [TableCheck("contract", quality.schema_contract(orders, contract))])


LEVELS = ["o_orderpriority", *[f"o_orderpriority{i}" for i in range(2, 8)]]


@query(
    "q10_row_distinct",
    f"""
    SELECT * FROM ({HIERARCHY_SQL}) h WHERE (SELECT COUNT(v) <> COUNT(DISTINCT v) FROM (VALUES {", ".join(f"({c})" for c in LEVELS)}) x(v))
    """,
)
def row_distinct(t):
    return quality.row_distinct(joins.hierarchy(t("orders"), "o_custkey", "o_orderpriority"), LEVELS)


@query(
    "q_run_checks",
    """
    SELECT 'not_null' AS check_name, 'error' AS severity, COUNT(*) FILTER (WHERE l_partkey IS NULL) AS failures FROM lineitem
    UNION ALL SELECT 'discount_range', 'warn', COUNT(*) FILTER (WHERE l_discount > 0.05) FROM lineitem
    UNION ALL SELECT 'price_positive', 'error', COUNT(*) FILTER (WHERE NOT l_extendedprice > 1000) FROM lineitem
    UNION ALL SELECT 'one_line', 'warn', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    UNION ALL SELECT 'has_part', 'error', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    """,
)
def run_checks(t):
    lines = t("lineitem")
    rows = [
        RowCheck("not_null", quality.null_in("l_partkey")),
        RowCheck("discount_range", quality.outside("l_discount", 0, 0.05), "warn"),
        RowCheck("price_positive", quality.not_true("l_extendedprice > 1000")),
    ]
    tables = [
        TableCheck("has_part", quality.relationships(lines, "l_partkey", t("part"), "p_partkey")),
    ]
    return quality.run_checks(lines, rows, tables, [UniqueCheck("one_line", ("l_orderkey", "l_linenumber"), "warn")])


@query(
    "q_unique_checks",
    """
    SELECT 'one_line' AS check_name, 'warn' AS severity, COUNT(*) AS failures
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    UNION ALL SELECT 'one_part', 'warn', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1)
    UNION ALL SELECT 'one_supplier', 'error', COUNT(*)
    FROM (SELECT 1 FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey HAVING COUNT(*) > 1)
    """,
)
def unique_checks(t):
    checks = [
        UniqueCheck("one_line", ("l_orderkey", "l_linenumber"), "warn"),
        UniqueCheck("one_part", ("l_orderkey", "l_partkey"), "warn"),
        UniqueCheck("one_supplier", ("l_suppkey",), ignore_nulls=True),
    ]
    return quality.run_checks(t("lineitem"), unique_checks=checks)
