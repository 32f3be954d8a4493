"""Aggregations, sorts, unions and row generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.joins import SEGMENT_CODES
from tidemark.functions import dates, numbers
from tidemark.operators import aggregates, joins, ordering, relations


@query("a1_dimension", "SELECT p_brand, p_type FROM part GROUP BY p_brand, p_type")
def dimension(t):
    return aggregates.dimension(t("part"), "p_brand", "p_type")


@query("a2_distinct", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL")
def distinct(t):
    return aggregates.dimension(t("lineitem").where("l_orderkey is not null"), "l_orderkey")


@query(
    "a3_grouped_count",
    """
    SELECT o_custkey, o_orderstatus, COUNT(NULLIF(o_orderpriority, '5-LOW')) AS num_orders
    FROM orders GROUP BY o_custkey, o_orderstatus
    """,
)
def grouped_count(t):
    orders = t("orders").withColumn("urgent", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return aggregates.grouped_count(orders, ["o_custkey", "o_orderstatus"], "urgent", "num_orders")


@query(
    "a4_group_size",
    """
    SELECT kind, COUNT(*) AS count FROM (SELECT NULLIF(event_type, 'error') AS kind FROM events)
    WHERE kind IS NOT NULL GROUP BY kind
    """,
)
def group_size(t):
    return aggregates.group_size(t("events").select(F.nullif("event_type", F.lit("error")).alias("kind")), "kind")


@query(
    "a5_group_range",
    """
    SELECT user_id, MIN(CAST(ts AS DATE)) AS min_date, MAX(CAST(ts AS DATE)) AS max_date FROM events GROUP BY user_id
    """,
)
def group_range(t):
    days = t("events").select("user_id", F.col("ts").cast("date").alias("day"))
    return aggregates.group_range(days, "user_id", "day", "min_date", "max_date")


@query("a6_global_range", "SELECT MIN(ts) AS first_ts, MAX(ts) AS latest_ts, COUNT(*) AS n FROM events")
def global_range(t):
    return t("events").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("latest_ts"), F.count(F.lit(1)).alias("n")
    )


@query(
    "a7_row_repeats",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (SELECT COUNT(v) <> COUNT(DISTINCT v) FROM (VALUES (l_partkey), (l_suppkey), (NULLIF(l_linenumber, 3))) x(v)) AS repeats
    FROM lineitem
    """,
)
def row_repeats(t):
    third = F.nullif(F.col("l_linenumber").cast("bigint"), F.lit(3).cast("bigint"))
    repeats = aggregates.has_repeats([F.col("l_partkey"), F.col("l_suppkey"), third])
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", repeats.alias("repeats"))


@query(
    "a8_last_values",
    """
    SELECT user_id, arg_max(value, (ts, event_id)) AS value,
           arg_max(kind, (ts, event_id)) FILTER (WHERE kind IS NOT NULL) AS kind
    FROM (SELECT *, NULLIF(event_type, 'error') AS kind FROM events) GROUP BY user_id
    """,
)
def last_values(t):
    events = t("events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    return aggregates.last_values(events, ["user_id"], ["ts", "event_id"], ["value", "kind"])


STATUS_SQL = """
    SELECT user_id, CAST(ts AS DATE) AS day, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success'
        ELSE 'skipped_no_new_data' END AS status FROM events
"""


@query(
    "a9_status_rollup",
    f"""
    WITH s AS ({STATUS_SQL}), f AS (
        SELECT user_id, day, bool_or(status = 'success') AS ok, bool_and(status = 'skipped_no_new_data') AS skipped,
               bool_and(status = 'failed') AS failed, COUNT(*) FILTER (status = 'success') AS n_loaded
        FROM s GROUP BY user_id, day)
    SELECT user_id, day, n_loaded,
        CASE WHEN ok THEN 'load' WHEN skipped THEN 'skip' ELSE 'error' END AS any_success,
        CASE WHEN skipped THEN 'skip' WHEN failed THEN 'error' ELSE 'load' END AS not_all_bad,
        CASE WHEN skipped THEN 'skip' WHEN failed THEN 'error' WHEN ok THEN 'load' ELSE 'skip' END AS need_success
    FROM f
    """,
)
def status_rollup(t):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "purchase", "success").otherwise("skipped_no_new_data")
    rows = t("events").select("user_id", F.col("ts").cast("date").alias("day"), status.alias("status"))
    return rows.groupBy("user_id", "day").agg(
        *[aggregates.decision("status", rule).alias(rule) for rule in aggregates.RULES],
        aggregates.loaded_count("status").alias("n_loaded"),
    )


@query(
    "a10_processed_total",
    """
    SELECT CAST(SUM(n) AS BIGINT) AS processed_records, COUNT(*) AS n_extracts
    FROM (SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type)
    """,
)
def processed_total(t):
    return aggregates.processed_total(aggregates.group_size(t("events"), "event_type", "n"), "n")


@query("o1_order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def order_by(t):
    return ordering.ordered(t("customer").select("c_custkey", "c_acctbal"), F.desc("c_acctbal"), "c_custkey")


@query(
    "o2_top_n",
    "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey ASC LIMIT 50",
)
def top_n(t):
    rows = t("orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return ordering.top_n(rows, 50, F.desc("o_orderdate"), F.asc("o_orderkey"))


@query(
    "u1_date_series",
    """
    SELECT user_id, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_col
    FROM (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_day, MAX(CAST(ts AS DATE)) AS last_day FROM events GROUP BY user_id)
    """,
)
def date_series(t):
    days = t("events").select("user_id", F.col("ts").cast("date").alias("day"))
    ranges = aggregates.group_range(days, "user_id", "day", "first_day", "last_day")
    return dates.explode_days(ranges, "first_day", "last_day").select("user_id", "date_col")


@query(
    "u2_union_all",
    """
    SELECT c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def union_all(t):
    customers = t("customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.col("c_acctbal").alias("balance")
    )
    return relations.union_all([customers, t("supplier").select("s_suppkey", "s_name", "s_acctbal")])


@query(
    "u3_columns_to_rows",
    """
    SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS val FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
    """,
)
def columns_to_rows(t):
    return relations.columns_to_rows(
        t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "val"
    )


@query(
    "u4_key_union",
    """
    SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10'
    UNION SELECT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05'
    """,
)
def key_union(t):
    events = t("events")
    known = events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).select("user_id", "event_type")
    new = events.where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")).select("user_id", "event_type")
    return relations.union_keys(known, new)


@query(
    "u5_inline_values",
    """
    SELECT v.segment, v.code, COUNT(c.c_custkey) AS n FROM (VALUES ('BUILDING', 1), ('MACHINERY', 2), ('HOUSEHOLD', 3),
        ('UNUSED', 4)) v(segment, code) LEFT JOIN customer c ON c.c_mktsegment = v.segment GROUP BY v.segment, v.code
    """,
)
def inline_values(t):
    values = relations.inline_rows(t.spark, SEGMENT_CODES, "segment string, code int")
    counted = joins.aggregate_lookup(values, t("customer"), "segment", "c_mktsegment", F.count("c_custkey").alias("n"))
    return counted.na.fill(0, ["n"])


@query(
    "u6_year_chunks",
    """
    SELECT r.o_custkey, greatest(r.lo, make_date(y.y, 1, 1)) AS chunk_start, least(r.hi, make_date(y.y, 12, 31)) AS chunk_end
    FROM (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi
          FROM orders GROUP BY o_custkey) r,
         LATERAL (SELECT unnest(range(EXTRACT(YEAR FROM r.lo), EXTRACT(YEAR FROM r.hi) + 1)) AS y) y
    """,
)
def year_chunks(t):
    days = t("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    ranges = aggregates.group_range(days, "o_custkey", "day", "lo", "hi")
    return dates.explode_year_chunks(ranges, "lo", "hi").select("o_custkey", "chunk_start", "chunk_end")


@query(
    "f18_vector_distance",
    """
    SELECT vec_id, label, ROUND(sqrt(list_sum(list_transform(list_zip(embedding, before), lambda x:
        (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))), 4) AS distance
    FROM (SELECT *, LAG(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM embeddings)
    """,
)
def vector_distance(t):
    from tidemark.operators.windows import lagged, over_previous

    rows = over_previous(t("embeddings"), ["label"], ["vec_id"], ["embedding"], 1, {"before": lagged("embedding")})
    distance = numbers.round_ieee(numbers.vector_distance("embedding", "before"), 4)
    return rows.select("vec_id", "label", distance.alias("distance"))
