"""Projections, filters and scalar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions import dates, keys, numbers, text

# Fixed values of the bindings below; they are repeated in the SQL.
AS_OF = dt.date(2024, 1, 20)
NAME_WORDS = [("Red", r"^red\b"), ("Blue", r"^blue\b"), ("Small", r"^small\b"), ("Large", r"^large\b"), ("Hot", r"^hot\b")]
NAME_LIKES = [
    ("Fastener", ["%bolt%", "%ring%"]),
    ("Colour", ["%RED%", "%blue%"]),
    ("Machine", ["%gear%", "%widget%", "%gizmo%"]),
]
PRIORITY_WORDS = [("Hurry", ["1-urgent", "2-high"]), ("Normal", ["3-medium"]), ("Later", ["4-not specified", "5-low"])]


@query(
    "p1_projection_rename",
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, c_acctbal AS balance
    FROM customer
    """,
)
def projection_rename(t):
    return t("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


@query(
    "p2_not_null_filter",
    """
    SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL
    """,
)
def not_null_filter(t):
    docs, labels = t("documents").select("doc_id", "lang"), t("labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query(
    "p3_in_list_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')",
)
def in_list_filter(t):
    return (
        t("customer")
        .where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"))
        .select("c_custkey", "c_mktsegment")
    )


@query(
    "p3_in_relation_filter",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)
    """,
)
def in_relation_filter(t):
    wanted = t("part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"))
    return t("lineitem").join(wanted, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query("p4_date_range_filter", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' - 1")
def date_range_filter(t):
    limit = F.date_sub(F.lit(AS_OF), 1)
    # Stated on the timestamp itself, so that the bound reaches the scan.
    before = F.date_add(limit, 1).cast("timestamp_ntz")
    return t("events").where(F.col("ts") < before).select("event_id", "ts")


@query(
    "p5_casts",
    """
    SELECT event_id, CAST(value AS DECIMAL(18,3)) AS price, CAST(ts AS DATE) AS day,
           TRY_CAST(event_type AS INTEGER) AS as_number, CAST(user_id AS INTEGER) AS user_no
    FROM events
    """,
)
def casts(t):
    return t("events").select(
        "event_id",
        F.col("value").cast("decimal(18,3)").alias("price"),
        F.col("ts").cast("date").alias("day"),
        text.to_integer("event_type").alias("as_number"),
        F.col("user_id").cast("int").alias("user_no"),
    )


@query("p6_arithmetic", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def arithmetic(t):
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return t("lineitem").select("l_orderkey", "l_linenumber", net.alias("net"))


@query(
    "p7_boolean_default",
    """
    SELECT d.doc_id, COALESCE(EXTRACT(DOW FROM l.seen) IN (0, 6), FALSE) AS is_weekend
    FROM documents d LEFT JOIN (
        SELECT doc_id, DATE '2024-01-01' + CAST(doc_id AS INTEGER) AS seen FROM labels) l ON d.doc_id = l.doc_id
    """,
)
def boolean_default(t):
    seen = t("labels").select("doc_id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("doc_id").cast("int")).alias("seen"))
    weekend = F.coalesce(dates.day_of_week("seen").isin(0, 6), F.lit(False))
    return t("documents").select("doc_id").join(seen, "doc_id", "left").select("doc_id", weekend.alias("is_weekend"))


@query(
    "p8_case_regex",
    r"""
    SELECT p_partkey, CASE
        WHEN regexp_matches(p_name, '^red\b', 'i') THEN 'Red'
        WHEN regexp_matches(p_name, '^blue\b', 'i') THEN 'Blue'
        WHEN regexp_matches(p_name, '^small\b', 'i') THEN 'Small'
        WHEN regexp_matches(p_name, '^large\b', 'i') THEN 'Large'
        WHEN regexp_matches(p_name, '^hot\b', 'i') THEN 'Hot'
        ELSE 'Other' END AS name_group
    FROM part
    """,
)
def case_regex(t):
    return t("part").select("p_partkey", text.classify_regex("p_name", NAME_WORDS).alias("name_group"))


@query(
    "p9_case_ilike",
    """
    SELECT p_partkey, CASE
        WHEN p_name ILIKE '%bolt%' OR p_name ILIKE '%ring%' THEN 'Fastener'
        WHEN p_name ILIKE '%RED%' OR p_name ILIKE '%blue%' THEN 'Colour'
        WHEN p_name ILIKE '%gear%' OR p_name ILIKE '%widget%' OR p_name ILIKE '%gizmo%' THEN 'Machine'
        ELSE 'Other' END AS name_group
    FROM part
    """,
)
def case_ilike(t):
    return t("part").select("p_partkey", text.classify_like("p_name", NAME_LIKES).alias("name_group"))


@query(
    "p10_case_member",
    """
    SELECT o_orderkey, CASE
        WHEN LOWER(o_orderpriority) IN ('1-urgent', '2-high') THEN 'Hurry'
        WHEN LOWER(o_orderpriority) IN ('3-medium') THEN 'Normal'
        WHEN LOWER(o_orderpriority) IN ('4-not specified', '5-low') THEN 'Later'
        ELSE 'Unknown' END AS urgency
    FROM orders
    """,
)
def case_member(t):
    return t("orders").select("o_orderkey", text.classify_members("o_orderpriority", PRIORITY_WORDS).alias("urgency"))


@query(
    "p11_case_like_prefix",
    """
    SELECT page_id, CASE
        WHEN url ILIKE '%UTM_source%' THEN 'Tracked'
        WHEN LOWER(url) LIKE 'https://m.%' THEN 'Mobile'
        WHEN url ILIKE '%blog.%' OR url ILIKE '%news.%' THEN 'Writing'
        WHEN url ILIKE '%page=%' THEN 'Paged'
        ELSE 'Other' END AS url_group
    FROM pages
    """,
)
def case_like_prefix(t):
    url = F.col("url")
    rules = [
        ("Tracked", url.ilike("%UTM_source%")),
        ("Mobile", F.lower(url).like("https://m.%")),
        ("Writing", url.ilike("%blog.%") | url.ilike("%news.%")),
        ("Paged", url.ilike("%page=%")),
    ]
    return t("pages").select("page_id", text.first_match(rules, "Other").alias("url_group"))


@query(
    "p12_lateral_alias",
    """
    SELECT c_custkey, c_mktsegment AS segment, LOWER(c_mktsegment) AS label,
           md5(COALESCE(LOWER(c_mktsegment), '_dbt_utils_surrogate_key_null_')) AS label_sk
    FROM customer
    """,
)
def lateral_alias(t):
    return (
        t("customer")
        .select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lower("segment").alias("label"))
        .withColumn("label_sk", keys.surrogate_key("label"))
    )


@query(
    "p13_group_by_alias",
    """
    SELECT o_orderstatus AS status, o_custkey FROM orders GROUP BY o_orderstatus, status, o_custkey
    """,
)
def group_by_alias(t):
    return t("orders").select(F.col("o_orderstatus").alias("status"), "o_custkey").groupBy("status", "o_custkey").agg(
        F.count(F.lit(1)).alias("_n")
    ).drop("_n")


@query("p14_filled_filter", "SELECT doc_id, source FROM documents WHERE text IS NOT NULL AND text <> ''")
def filled_filter(t):
    return t("documents").where(text.is_filled("text")).select("doc_id", "source")


@query(
    "f1_numeric_tail",
    r"""
    SELECT page_id, TRY_CAST(regexp_replace(regexp_replace(url, '[?#].*$', ''), '.*/(\d+)$', '\1') AS INTEGER) AS page_no
    FROM pages
    """,
)
def numeric_tail(t):
    path = F.regexp_replace("url", r"[?#].*$", "")
    return t("pages").select("page_id", text.numeric_tail(path).alias("page_no"))


@query(
    "f2_regex_match",
    r"SELECT p_partkey, regexp_matches(p_name, '^(RED|blue)\b.*r', 'i') AS matches FROM part",
)
def regex_match(t):
    return t("part").select("p_partkey", F.col("p_name").rlike(r"(?i)^(RED|blue)\b.*r").alias("matches"))


@query(
    "f3_like_lower",
    """
    SELECT p_partkey, p_name ILIKE '%BOLT' AS a, p_name LIKE 'red %' AS b, LOWER(p_brand) AS brand, p_name LIKE '_o%' AS c
    FROM part
    """,
)
def like_lower(t):
    name = F.col("p_name")
    return t("part").select(
        "p_partkey",
        name.ilike("%BOLT").alias("a"),
        name.like("red %").alias("b"),
        F.lower("p_brand").alias("brand"),
        name.like("_o%").alias("c"),
    )


@query(
    "f4_fixed_substring",
    """
    SELECT c_custkey, CAST(SUBSTR(c_name, 10, 5) AS INTEGER) AS high_part, CAST(SUBSTR(c_name, 15, 4) AS INTEGER) AS low_part
    FROM customer
    """,
)
def fixed_substring(t):
    return t("customer").select(
        "c_custkey",
        text.code_part("c_name", 10, 5).alias("high_part"),
        text.code_part("c_name", 15, 4).alias("low_part"),
    )


@query(
    "f5_composite_key",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) || '|' || COALESCE(LOWER(event_type), '') || '|'
           || COALESCE(LOWER(NULLIF(event_type, 'error')), '') AS seen_key
    FROM events
    """,
)
def composite_key(t):
    return t("events").select(
        "event_id",
        keys.composite_key("user_id", "event_type", F.nullif("event_type", F.lit("error"))).alias("seen_key"),
    )


@query(
    "f6_surrogate_key",
    """
    SELECT o_orderkey,
           md5(COALESCE(CAST(o_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS order_sk,
           md5(COALESCE(CAST(o_custkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-'
               || COALESCE(NULLIF(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) AS pair_sk
    FROM orders
    """,
)
def surrogate_key(t):
    return t("orders").select(
        "o_orderkey",
        keys.surrogate_key("o_orderkey").alias("order_sk"),
        keys.surrogate_key("o_custkey", F.nullif("o_orderstatus", F.lit("P"))).alias("pair_sk"),
    )


@query(
    "f7_sanitize_name",
    r"""
    SELECT doc_id, regexp_replace(regexp_replace(text, '[\s\x0b\x1c-\x1f]+|[^\x00-\x7F]+', '', 'g'),
                                  '[^A-Za-z0-9_.\-]', '_', 'g') AS file_name
    FROM documents
    """,
)
def sanitize_name(t):
    return t("documents").select("doc_id", keys.sanitize_name("text").alias("file_name"))


@query(
    "f8_path_parts",
    """
    SELECT page_id, list_extract(string_split(url, '/'), -1) AS tail, starts_with(url, 'https://') AS is_secure,
           trim(p_text) AS label
    FROM (SELECT page_id, url, '  ' || url || ' ' AS p_text FROM pages)
    """,
)
def path_parts(t):
    return t("pages").select(
        "page_id",
        keys.last_segment("url").alias("tail"),
        F.col("url").startswith("https://").alias("is_secure"),
        F.trim(F.concat(F.lit("  "), "url", F.lit(" "))).alias("label"),
    )


@query(
    "f9_zone_shift",
    """
    SELECT event_id, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')::TIMESTAMP AS local_ts FROM events
    """,
)
def zone_shift(t):
    return t("events").select("event_id", dates.to_zone("ts").alias("local_ts"))


@query(
    "f10_zone_date",
    "SELECT event_id, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')::DATE AS local_day FROM events",
)
def zone_date(t):
    return t("events").select("event_id", dates.zone_date("ts").alias("local_day"))


@query(
    "f11_parse_date",
    "SELECT o_orderkey, strptime(strftime(o_orderdate, '%B %d, %Y'), '%B %d, %Y')::TIMESTAMP AS parsed FROM orders",
)
def parse_date(t):
    written = F.date_format("o_orderdate", "MMMM d, yyyy")
    return t("orders").select("o_orderkey", dates.parse_long_date(written).alias("parsed"))


CALENDAR_SQL = """
    EXTRACT(YEAR FROM d) AS year_col, EXTRACT(MONTH FROM d) AS month_col, EXTRACT(DAY FROM d) AS day_col,
    strftime(d, '%B') AS month_name, strftime(d, '%A') AS weekday_name, EXTRACT(DOW FROM d) AS day_of_week,
    COALESCE(EXTRACT(DOW FROM d) IN (0, 6), FALSE) AS is_weekend, EXTRACT(DOY FROM d) AS day_of_year,
    EXTRACT(WEEK FROM d) AS week_of_year, EXTRACT(QUARTER FROM d) AS quarter_col
"""


@query("f12_calendar", f"SELECT o_orderkey, {CALENDAR_SQL} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def calendar(t):
    return t("orders").select("o_orderkey", *dates.calendar_columns(F.col("o_orderdate").cast("date")))


@query(
    "f13_date_arithmetic",
    """
    SELECT event_id, CAST(ts AS DATE) + 1 AS next_day, CAST(ts AS DATE) - 1 AS day_before,
           ts + INTERVAL 30 MINUTE AS later, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS days
    FROM events
    """,
)
def date_arithmetic(t):
    return t("events").select(
        "event_id",
        F.date_add("ts", 1).alias("next_day"),
        F.date_sub("ts", 1).alias("day_before"),
        (F.col("ts") + F.expr("interval 30 minutes")).alias("later"),
        dates.day_span(F.lit(dt.date(2024, 1, 1)), "ts").cast("bigint").alias("days"),
    )


@query(
    "f14_noon_utc",
    """
    SELECT o_orderkey, strftime((CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR)
           AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS request_time
    FROM orders
    """,
)
def noon_utc(t):
    return t("orders").select("o_orderkey", dates.noon_utc_iso("o_orderdate").alias("request_time"))


@query(
    "f15_market_hours",
    """
    SELECT event_id, EXTRACT(ISODOW FROM local_ts) < 6
           AND CAST(local_ts AS TIME) BETWEEN TIME '10:00:00' AND TIME '16:00:00' AS is_open
    FROM (SELECT event_id, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney')::TIMESTAMP AS local_ts FROM events)
    """,
)
def market_hours(t):
    return t("events").select("event_id", dates.market_hours("ts").alias("is_open"))


@query(
    "f16_iso_text",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso_text,
           CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day,
           CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS whole_seconds
    FROM events
    """,
)
def iso_text(t):
    return t("events").select(
        "event_id",
        dates.iso_utc("ts").alias("iso_text"),
        F.to_date(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("whole_seconds"),
    )


@query(
    "f17_round_binary",
    "SELECT l_orderkey, l_linenumber, l_suppkey, ROUND(l_extendedprice * (1 - l_discount), 2) AS net FROM lineitem",
)
def round_binary(t):
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", numbers.round_ieee(net).alias("net"))


@query(
    "f19_tolerance",
    """
    SELECT l_orderkey, l_linenumber, abs(l_discount - l_tax) < 1e-6 AND abs(l_quantity - l_linenumber) < 1e-6 AS same
    FROM lineitem
    """,
)
def tolerance(t):
    same = numbers.within_tolerance([("l_discount", "l_tax"), ("l_quantity", "l_linenumber")])
    return t("lineitem").select("l_orderkey", "l_linenumber", same.alias("same"))


@query(
    "f20_page_count",
    """
    SELECT event_type, COUNT(*) AS n, CAST((COUNT(*) + 49) // 50 AS BIGINT) AS pages FROM events GROUP BY event_type
    """,
)
def page_count(t):
    counts = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pages", numbers.pages_needed("n", 50))
