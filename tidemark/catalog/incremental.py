"""Incremental loading."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.dates import explode_year_chunks
from tidemark.functions.keys import composite_key
from tidemark.operators import aggregates, incremental, ordering, relations
from tidemark.operators.history import instant

NOW = dt.datetime(2024, 2, 1, 8, 0)
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 30)


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _days(t):
    return t("events").select("user_id", F.col("ts").cast("date").alias("day"))


@query(
    "i1_watermark_gate",
    """
    WITH stored AS (SELECT MAX(ts) AS w FROM events WHERE ts < TIMESTAMP '2024-01-20'),
         batch AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15')
    SELECT event_id, ts FROM batch WHERE (SELECT MAX(ts) FROM batch) > (SELECT w + INTERVAL 30 MINUTE FROM stored)
    """,
)
def watermark_gate(t):
    batch = t("events").where(F.col("ts") >= _at("2024-01-15")).select("event_id", "ts")
    return incremental.watermark_gate(batch, _watermark(t), "ts", NOW)[0]


@query(
    "i1_watermark_state",
    """
    WITH stored AS (SELECT MAX(ts) AS w, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20')
    SELECT 'later' AS batch, (SELECT MAX(ts) FROM events) AS latest_ts, TIMESTAMP '2024-02-01 08:00:00' AS last_run,
           (SELECT COUNT(*) FROM events) AS processed_records, 'success' AS last_run_status
    UNION ALL SELECT 'known', w, TIMESTAMP '2024-02-01 08:00:00', n, 'skipped_no_new_data' FROM stored
    UNION ALL SELECT 'none', w, TIMESTAMP '2024-02-01 08:00:00', n, 'skipped_empty_data' FROM stored
    """,
)
def watermark_state(t):
    events, state = t("events"), _watermark(t)
    batches = {
        "later": events,
        "known": events.where(F.col("ts") < _at("2024-01-20")),
        "none": events.where(F.lit(False)),
    }
    states = {name: incremental.watermark_gate(b, state, "ts", NOW)[1] for name, b in batches.items()}
    return relations.union_tagged(states, "batch")


def _watermark(t):
    return t("events").where(F.col("ts") < _at("2024-01-20")).agg(
        F.max("ts").alias("latest_ts"),
        instant(NOW).alias("last_run"),
        F.count(F.lit(1)).alias("processed_records"),
        F.lit("success").alias("last_run_status"),
    )


@query(
    "i2_filter_unseen",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) || '|' || LOWER(event_type) AS seen_key FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND CAST(user_id AS VARCHAR) || '|' || LOWER(event_type) NOT IN (
        SELECT CAST(user_id AS VARCHAR) || '|' || LOWER(event_type) FROM events WHERE ts < TIMESTAMP '2024-01-10')
    """,
)
def filter_unseen(t):
    keyed = t("events").select("event_id", "ts", composite_key("user_id", "event_type").alias("seen_key"))
    seen = keyed.where(F.col("ts") < _at("2024-01-10")).select("seen_key").distinct()
    batch = keyed.where(F.col("ts") >= _at("2024-01-10"))
    return incremental.filter_unseen(batch, seen, "seen_key", t("events")).select("event_id", "seen_key")


CHANGE_VARIANTS = ("dropped", "dropped_or_empty", "growth", "both_equal")


@query(
    "i3_change_plan",
    """
    WITH c AS (
        SELECT user_id, COUNT(*) AS a, COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-29') AS p,
               COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-29' AND event_type <> 'error') AS b FROM events GROUP BY user_id)
    SELECT user_id, a AS api_count, p AS previous_count, b AS table_count,
        CASE WHEN b < p THEN 'reload' WHEN a = p THEN 'skip' ELSE 'load' END AS dropped,
        CASE WHEN b < p OR b = 0 THEN 'reload' WHEN a = p THEN 'skip' ELSE 'load' END AS dropped_or_empty,
        CASE WHEN p < a THEN 'reload' WHEN b > 0 AND a = p THEN 'skip' ELSE 'load' END AS growth,
        CASE WHEN a = p AND b = p THEN 'skip' WHEN a = 0 THEN 'failed' ELSE 'load' END AS both_equal
    FROM c
    """,
)
def change_plan(t):
    events = t("events")
    before = events.where(F.col("ts") < _at("2024-01-29"))
    counts = [aggregates.group_size(df, "user_id", "n") for df in (events, before, before.where("event_type <> 'error'"))]
    plan = incremental.change_plan(*counts, "user_id", "dropped").withColumnRenamed("status", "dropped")
    columns = [F.col(c) for c in ("api_count", "previous_count", "table_count")]
    return plan.withColumns({v: incremental.change_status(*columns, v) for v in CHANGE_VARIANTS[1:]})


GAP_SQL = """
    SELECT r.user_id, CASE WHEN (hi - lo + 1 >= 30 AND hi >= DATE '2024-01-30') OR start > DATE '2024-01-30' THEN 'skipped'
        WHEN hi IS NULL THEN 'new' ELSE 'update' END AS status, start
    FROM (SELECT u.user_id, c.lo, c.hi, COALESCE(greatest(c.hi + 1, DATE '2024-01-01'), DATE '2024-01-01') AS start
          FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (
              SELECT user_id, MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events
              WHERE event_type = 'error' GROUP BY user_id) c USING (user_id)) r
"""


def _gap_plan(t):
    loaded = t("events").where("event_type = 'error'").select("user_id", F.col("ts").cast("date").alias("day"))
    users = t("events").select("user_id").distinct()
    return incremental.gap_plan(users, loaded, "user_id", "day", FIRST_DAY, LAST_DAY)


@query(
    "i4_gap_plan",
    f"""
    SELECT user_id, status, CASE WHEN status <> 'skipped' THEN start END AS start_date,
           CASE WHEN status <> 'skipped' THEN DATE '2024-01-30' END AS end_date FROM ({GAP_SQL})
    """,
)
def gap_plan(t):
    return _gap_plan(t)


@query(
    "i4_gap_plan_chunks",
    f"""
    SELECT user_id, status, start AS chunk_start, DATE '2024-01-30' AS chunk_end FROM ({GAP_SQL}) WHERE status <> 'skipped'
    """,
)
def gap_plan_chunks(t):
    chunks = explode_year_chunks(_gap_plan(t).where("status <> 'skipped'"), "start_date", "end_date")
    return chunks.select("user_id", "status", "chunk_start", "chunk_end")


MISSING_SQL = """
    SELECT w.day, w.user_id FROM (
        SELECT u.user_id, CAST(d.day AS DATE) AS day FROM (SELECT DISTINCT user_id FROM events) u
        CROSS JOIN generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) d(day)) w
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = w.user_id AND CAST(e.ts AS DATE) = w.day)
    ORDER BY w.day DESC, w.user_id ASC LIMIT 50
"""


def _missing(t):
    days = _days(t)
    return incremental.missing_pairs(days.select("user_id").distinct(), days, "user_id", "day", FIRST_DAY, LAST_DAY)


@query("i5_missing_pairs", MISSING_SQL)
def missing_pairs(t):
    return _missing(t)


@query(
    "i5_missing_pairs_within_quota",
    f"""
    WITH m AS ({MISSING_SQL}), k AS (SELECT m.* FROM m WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
    SELECT DATE '2024-02-01' AS run_day, day, user_id FROM k ORDER BY day DESC, user_id ASC
    LIMIT (SELECT 50 - COUNT(DISTINCT event_type) * 4 FROM events)
    """,
)
def missing_pairs_within_quota(t):
    run_day = F.lit(dt.date(2024, 2, 1))
    used = t("events").agg((F.count_distinct("event_type") * 4).alias("used")).withColumn("run_day", run_day)
    known = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    requests = _missing(t).withColumn("run_day", run_day)
    order = [F.desc("day"), F.asc("user_id")]
    return ordering.quota_cap(requests, "run_day", order, 50, used, known, "user_id").select("run_day", "day", "user_id")


@query(
    "i9_suppress_unchanged",
    """
    WITH c AS (SELECT user_id, arg_max(value, (ts, event_id)) AS x, arg_max(length(props), (ts, event_id)) AS y,
                      arg_max(event_type, (ts, event_id)) AS kind FROM events GROUP BY user_id),
         p AS (SELECT user_id, arg_max(value, (ts, event_id)) AS x, arg_max(length(props), (ts, event_id)) AS y
               FROM events WHERE event_type <> 'click' AND ts < TIMESTAMP '2024-01-30' GROUP BY user_id)
    SELECT user_id, x, y, CASE WHEN kind = 'error' THEN 'failed' WHEN px IS NULL THEN 'firstrun'
               WHEN abs(x - px) < 1e-6 AND abs(y - py) < 1e-6 THEN 'skipped' ELSE 'success' END AS status,
           CASE WHEN kind <> 'error' AND NOT (abs(x - px) < 1e-6 AND abs(y - py) < 1e-6)
                THEN sqrt((x - px) * (x - px) + (y - py) * (y - py)) END AS distance_km
    FROM (SELECT c.user_id, c.x, CAST(c.y AS DOUBLE) AS y, c.kind, p.x AS px, CAST(p.y AS DOUBLE) AS py FROM c LEFT JOIN p USING (user_id))
    """,
)
def suppress_unchanged(t):
    events = t("events").select("*", F.col("value").alias("x"), F.length("props").cast("double").alias("y"))
    earlier = events.where((F.col("event_type") != "click") & (F.col("ts") < _at("2024-01-30")))
    current = aggregates.last_values(events, ["user_id"], ["ts", "event_id"], ["x", "y", "event_type"])
    state = aggregates.last_values(earlier, ["user_id"], ["ts", "event_id"], ["x", "y"])
    result = incremental.suppress_unchanged(current, state, "user_id", ["x", "y"], F.col("event_type") == "error")
    return result.select("user_id", "x", "y", "status", "distance_km")


@query("i10_fresh_rows", "SELECT event_id, ts FROM events WHERE TIMESTAMP '2024-01-28 12:00:00' - ts < INTERVAL 72 HOUR")
def fresh_rows(t):
    return incremental.fresh_rows(t("events"), "ts", dt.datetime(2024, 1, 28, 12)).select("event_id", "ts")


@query("i11_daily_usage", "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS used FROM events GROUP BY day")
def daily_usage(t):
    return incremental.daily_usage(_days(t), "day")


@query(
    "i11_usage_today",
    "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS used FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-17' GROUP BY day",
)
def usage_today(t):
    return incremental.daily_usage(_days(t), "day", dt.date(2024, 1, 17))


@query(
    "o3_quota_cap",
    """
    SELECT day, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, event_id) AS r FROM (
            SELECT CAST(ts AS DATE) AS day, ts, event_id FROM events
            WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))) JOIN (
        SELECT CAST(ts AS DATE) AS day, COUNT(*) AS used FROM events WHERE event_type = 'error' AND value < 3 GROUP BY 1)
        USING (day) WHERE r <= 50 - used
    UNION ALL SELECT day, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, event_id) AS r FROM (
            SELECT CAST(ts AS DATE) AS day, ts, event_id FROM events
            WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))) WHERE r <= 50 AND day NOT IN (
        SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'error' AND value < 3)
    """,
)
def quota_cap(t):
    events = t("events").withColumn("day", F.col("ts").cast("date"))
    used = incremental.daily_usage(events.where("event_type = 'error' and value < 3"), "day")
    known = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    order = ["ts", "event_id"]
    return ordering.quota_cap(events, "day", order, 50, used, known, "user_id").select("day", "event_id")
