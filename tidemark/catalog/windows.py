"""Window analytics. Event types hold a fifth of the rows each, so they are hot keys; users are not."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.keys import surrogate_key
from tidemark.functions.numbers import round_ieee
from tidemark.operators import ordering, windows

USER_WINDOW = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
TYPE_WINDOW = USER_WINDOW.replace("user_id", "event_type")
ORDER = ["ts", "event_id"]


def _events(t):
    return t("events").select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "w1_partition_spread",
    """
    SELECT event_id, ROUND(MAX(value) OVER (PARTITION BY event_type) - MIN(value) OVER (PARTITION BY event_type), 2) AS spread
    FROM events
    """,
)
def partition_spread(t):
    rows = windows.partition_values(_events(t), ["event_type"], _spread=F.max("value") - F.min("value"))
    return rows.select("event_id", round_ieee("_spread").alias("spread"))


@query(
    "w2_running_last_minus_first",
    """
    SELECT event_id, ROUND(arg_max(value, event_id) OVER (PARTITION BY event_type, ts)
        - first_value(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 2) AS movement
    FROM events
    """,
)
def running_last_minus_first(t):
    rows = windows.partition_values(_events(t), ["event_type"], _first=windows.first_value("value", ORDER))
    rows = windows.with_peer_last(rows, "_last", "value", ["event_type"], "ts", "event_id")
    return rows.select("event_id", round_ieee(F.col("_last") - F.col("_first")).alias("movement"))


@query(
    "w3_last_minus_first",
    """
    SELECT event_id, ROUND(last_value(value) OVER w - first_value(value) OVER w, 2) AS movement FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def last_minus_first(t):
    ends = {"_first": windows.first_value("value", ORDER), "_last": windows.last_value("value", ORDER)}
    rows = windows.partition_values(_events(t), ["event_type"], **ends)
    return rows.select("event_id", round_ieee(F.col("_last") - F.col("_first")).alias("movement"))


@query("w4_partition_count", "SELECT event_id, COUNT(event_id) OVER (PARTITION BY event_type) AS n FROM events")
def partition_count(t):
    return windows.partition_values(_events(t), ["event_type"], n=F.count("event_id")).select("event_id", "n")


@query("w5_trailing_mean", f"SELECT event_id, AVG(value) {USER_WINDOW} AS trailing FROM events")
def trailing_mean(t):
    exprs = {"trailing": windows.trailing_mean("value")}
    return windows.over_previous(_events(t), ["user_id"], ORDER, ["value"], 13, exprs).select("event_id", "trailing")


@query("w5_trailing_mean_hot_keys", f"SELECT event_id, event_type, AVG(value) {TYPE_WINDOW} AS trailing FROM events")
def trailing_mean_hot_keys(t):
    exprs = {"trailing": windows.trailing_mean("value")}
    rows = windows.over_previous(_events(t), ["event_type"], ORDER, ["value"], 13, exprs)
    return rows.select("event_id", "event_type", "trailing")


@query(
    "w6_trailing_anomaly",
    f"""
    SELECT event_id, value - AVG(value) {USER_WINDOW} AS value_anomaly, size - AVG(size) {USER_WINDOW} AS size_anomaly
    FROM (SELECT *, CAST(length(props) AS DOUBLE) AS size FROM events)
    """,
)
def trailing_anomaly(t):
    events = t("events").withColumn("size", F.length("props").cast("double"))
    exprs = {"value_anomaly": windows.trailing_anomaly("value"), "size_anomaly": windows.trailing_anomaly("size")}
    rows = windows.over_previous(events, ["user_id"], ORDER, ["value", "size"], 13, exprs)
    return rows.select("event_id", *exprs)


@query(
    "w7_lag_difference",
    "SELECT event_id, value - LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change FROM events",
)
def lag_difference(t):
    exprs = {"change": windows.lag_difference("value")}
    return windows.over_previous(_events(t), ["user_id"], ORDER, ["value"], 1, exprs).select("event_id", "change")


@query(
    "flagship_series_report",
    f"""
    SELECT md5(COALESCE(CAST(user_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
               COALESCE(event_type, '_dbt_utils_surrogate_key_null_')) AS series_sk,
           user_id, ts, event_id, value, AVG(value) {USER_WINDOW} AS fortnight_avg,
           value - AVG(value) {USER_WINDOW} AS fortnight_anomaly,
           value - LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 50
    """,
)
def series_report(t):
    exprs = {
        "fortnight_avg": windows.trailing_mean("value"),
        "fortnight_anomaly": windows.trailing_anomaly("value"),
        "change": windows.lag_difference("value"),
    }
    rows = windows.over_previous(_events(t), ["user_id"], ORDER, ["value"], 13, exprs)
    newest = ordering.top_n(rows, 50, F.desc("ts"), F.desc("event_id"))
    key = surrogate_key("user_id", "event_type").alias("series_sk")
    return newest.select(key, "user_id", "ts", "event_id", "value", *exprs)
