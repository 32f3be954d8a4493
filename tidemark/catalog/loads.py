"""Sources, load dispositions and the shaping of nested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.operators import incremental, loading, relations, shaping, stored
from tidemark.session import new_shared_path, shuffle_partitions
from tidemark.sources import writers
from tidemark.sources.layouts import BENCH_TABLES
from tidemark.sources.stored import StoredTable
from tidemark.streaming import drivers


@query("s1_declared_table", "SELECT * FROM orders")
def declared_table(t):
    return t("orders")


@query(
    "s3_materialise_table",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
)
def materialise_table(t):
    path = new_shared_path(t.spark, "orders_stored")
    writers.replace_table(t("orders").select("o_orderkey", "o_custkey"), path)
    writers.replace_table(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return writers.read_table(t.spark, path)


@query(
    "s4_materialise_view",
    "SELECT user_id, COUNT(*) AS n, MAX(ts) AS latest FROM events GROUP BY user_id",
)
def materialise_view(t):
    per_user = t("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
    return writers.as_view(per_user, "events_per_user")


MERGE_SQL = """
    WITH u AS (
        SELECT o_orderkey, o_custkey, 'O' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1 AS seq
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT o_orderkey, o_custkey, 'F', o_totalprice * 2, o_orderdate, o_orderpriority, 2
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1
        FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)
    UNION ALL SELECT * EXCLUDE (seq) FROM u WHERE seq = 2 OR o_orderkey < 0
    """


def order_updates(t):
    orders = t("orders")
    pending = orders.where("o_orderstatus = 'P'")
    first = pending.withColumn("o_orderstatus", F.lit("O")).withColumn("seq", F.lit(1))
    second = (
        pending.withColumn("o_orderstatus", F.lit("F"))
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
        .withColumn("seq", F.lit(2))
    )
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    added = urgent.withColumn("o_orderkey", F.lit(-1) - F.col("o_orderkey")).withColumn("seq", F.lit(1))
    return first.unionByName(second).unionByName(added)


@query("s5_merge_upsert", MERGE_SQL)
def merge_upsert(t):
    return loading.merge_upsert(t("orders"), order_updates(t), ["o_orderkey"], ["seq"])


@query("s5_merge_stored", MERGE_SQL)
def merge_stored(t):
    table = StoredTable(t.spark, new_shared_path(t.spark, "orders_merged"), ["o_orderkey"], shuffle_partitions(t.spark))
    stored.merge_stored(table, t("orders"), ["o_orderkey"])
    stored.merge_stored(table, order_updates(t), ["seq"])
    return table.read()


APPEND_SQL = """
    SELECT event_id, ts, user_id, NULL::DOUBLE AS value FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT event_id, ts, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    """


@query("s6_append_commits", APPEND_SQL)
def append_commits(t):
    path = new_shared_path(t.spark, "events_appended")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    writers.append_table(t("events").where(F.col("ts") < cut).select("event_id", "ts", "user_id"), path)
    writers.append_table(t("events").where(F.col("ts") >= cut).select("event_id", "ts", "user_id", "value"), path)
    return writers.read_table(t.spark, path)


@query("s6_append", APPEND_SQL)
def append(t):
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    stored = t("events").where(F.col("ts") < cut).select("event_id", "ts", "user_id")
    return loading.append_rows(stored, t("events").where(F.col("ts") >= cut).select("event_id", "ts", "user_id", "value"))


@query(
    "s7_replace",
    """
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    """,
)
def replace(t):
    orders = t("orders")
    return loading.replace_rows(orders, orders.withColumn("o_orderstatus", F.lit("F")))


@query(
    "s8_snake_case_columns",
    "SELECT c_custkey AS cust_key, c_name AS full_name, c_acctbal AS acct_bal1, c_mktsegment AS date_time FROM customer",
)
def snake_case_columns(t):
    camel = t("customer").select(
        F.col("c_custkey").alias("custKey"),
        F.col("c_name").alias("FullName"),
        F.col("c_acctbal").alias("acctBal1"),
        F.col("c_mktsegment").alias("DateTime"),
    )
    return shaping.snake_case_columns(camel)


@query(
    "s9_flatten_structs",
    """
    SELECT c_custkey, c_acctbal AS account__balance, c_mktsegment AS account__market__segment,
           c_nationkey AS account__market__nation FROM customer
    """,
)
def flatten_structs(t):
    market = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    account = F.struct(F.col("c_acctbal").alias("balance"), market.alias("market"))
    return shaping.flatten_structs(t("customer").select("c_custkey", account.alias("account")))


@query(
    "s10_scalar_child_table",
    """
    SELECT value, _dlt_list_idx, md5(vec_id || '|embedding|' || _dlt_list_idx) AS _dlt_id, vec_id AS _dlt_root_id
    FROM (SELECT vec_id, unnest(embedding) AS value, unnest(range(len(embedding))) AS _dlt_list_idx FROM embeddings)
    """,
)
def scalar_child_table(t):
    return shaping.explode_child(t("embeddings"), "vec_id", "embedding")


@query(
    "s11_struct_child_table",
    r"""
    SELECT line, len, _dlt_list_idx, md5(doc_id || '|lines|' || _dlt_list_idx) AS _dlt_id, doc_id AS _dlt_root_id
    FROM (SELECT doc_id, line, CAST(length(line) AS INTEGER) AS len, i - 1 AS _dlt_list_idx
          FROM documents, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                                          generate_subscripts(string_split(text, chr(10)), 1) AS i))
    """,
)
def struct_child_table(t):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("len")))
    return shaping.explode_child(t("documents").select("doc_id", lines.alias("lines")), "doc_id", "lines")


@query(
    "s12_arrays_to_rows",
    """
    SELECT vec_id, label, i - 1 AS position, embedding[i] AS amount, CAST(embedding[i] AS DOUBLE) * 2 AS doubled
    FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)
    """,
)
def arrays_to_rows(t):
    rows = t("embeddings").withColumn("twice", F.transform("embedding", lambda x: x.cast("double") * 2))
    return shaping.arrays_to_rows(rows, ["vec_id", "label"], {"amount": "embedding", "doubled": "twice"})


@query(
    "s13_pluck_records",
    """
    SELECT p_partkey, p_name AS title FROM part UNION ALL SELECT p_partkey, p_brand FROM part
    """,
)
def pluck_records(t):
    drinks = F.array(
        F.struct(F.col("p_name").alias("strName"), F.col("p_size").alias("size")),
        F.struct(F.lit(None).cast("string").alias("strName"), F.col("p_size").alias("size")),
        F.struct(F.col("p_brand").alias("strName"), F.lit(None).cast("int").alias("size")),
    )
    # Null fields are left out of the text, so the second record lacks the name.
    document = F.to_json(F.struct(F.lit(3).alias("count"), F.array(F.lit(1)).alias("ids"), drinks.alias("drinks")))
    return shaping.pluck_records(t("part").select("p_partkey", document.alias("doc")), "doc", "strName", "title").select(
        "p_partkey", "title"
    )


@query(
    "s14_tagged_extracts",
    """
    SELECT c_custkey AS party, c_name AS name, NULL::INTEGER AS nation, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'supplier' FROM supplier
    """,
)
def tagged_extracts(t):
    customers = t("customer").select(F.col("c_custkey").alias("party"), F.col("c_name").alias("name"))
    suppliers = t("supplier").select(
        F.col("s_suppkey").alias("party"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return relations.union_tagged({"customer": customers, "supplier": suppliers}, "kind")


@query(
    "s16_stride_records",
    r"""
    SELECT doc_id, i // 3 AS record_no, trim(l[i + 1]) AS satellite_name, l[i + 2] AS tle_line1, l[i + 3] AS tle_line2,
           CASE WHEN regexp_matches(substr(l[i + 2], 3, 5), '^\s*[+-]?\d+\s*$')
                THEN TRY_CAST(trim(substr(l[i + 2], 3, 5)) AS BIGINT) END AS satellite_id
    FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(
              text || chr(10) || '1 ' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || 'U' || chr(10) || '2 ',
              '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g'), '\r\n|\r|\n') AS l FROM documents),
        LATERAL (SELECT unnest(range(0, len(l) - 2, 3)) AS i)
    """,
)
def stride_records(t):
    lines = F.concat("text", F.lit("\n1 "), F.lpad(F.col("doc_id").cast("string"), 5, "0"), F.lit("U\n2 "))
    return shaping.element_set_records(t("documents").select("doc_id", lines.alias("text")), "text")


@query(
    "s17_required_columns",
    """
    SELECT 'ready' AS status, COUNT(*) AS row_count, 'complete' AS kind FROM events
    UNION ALL SELECT 'skipped_missing_datetime', COUNT(*), 'incomplete' FROM events
    UNION ALL SELECT 'skipped_empty_data', 0, 'empty'
    """,
)
def required_columns(t):
    events = t("events")
    gates = {
        "complete": incremental.required_columns_gate(events, ["ts"]),
        "incomplete": incremental.required_columns_gate(events, ["DateTime"]),
        "empty": incremental.required_columns_gate(events.where(F.lit(False)), ["DateTime"]),
    }
    return relations.union_tagged(gates, "kind")


@query("s18_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in BENCH_TABLES))
def row_counts(t):
    return relations.row_counts({name: t(name) for name in BENCH_TABLES})


@query(
    "s19_subject_rows",
    """
    SELECT 'W' || page_id AS work_id, subject FROM (
        SELECT page_id, unnest(string_split(url, '/')) AS subject FROM pages WHERE starts_with(url, 'https'))
    WHERE subject <> ''
    """,
)
def subject_rows(t):
    folder = F.when(F.col("url").startswith("https"), F.lit("/works/W")).otherwise(F.lit("/authors/A"))
    keyed = t("pages").select(F.concat(folder, F.col("page_id")).alias("key"), F.split("url", "/").alias("subjects"))
    return shaping.subject_rows(keyed, "key", "subjects")


@query(
    "s20_combine_extracts",
    """
    SELECT c_nationkey AS nation, c_name AS name, 'customers' AS source, FALSE AS failed FROM customer
    UNION ALL SELECT s_nationkey, s_name, 'suppliers', FALSE FROM supplier
    UNION ALL SELECT NULL, NULL, 'partners', TRUE
    """,
)
def combine_extracts(t):
    extracts = {
        "customers": t("customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")),
        "partners": None,
        "suppliers": t("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")),
    }
    rows, failed = relations.combine_extracts(t.spark, extracts, "source")
    return rows.withColumn("failed", F.lit(False)).unionByName(
        failed.withColumn("failed", F.lit(True)), allowMissingColumns=True
    )


@query(
    "s21_describe_columns",
    """
    SELECT c.column_name, c.column_type, c.position, v.n_values FROM (VALUES
        ('event_id', 'bigint', 0), ('ts', 'timestamp_ntz', 1), ('user_id', 'bigint', 2), ('event_type', 'string', 3),
        ('value', 'double', 4), ('props', 'string', 5)) c(column_name, column_type, position)
    JOIN (UNPIVOT (SELECT COUNT(event_id) AS event_id, COUNT(ts) AS ts, COUNT(user_id) AS user_id,
        COUNT(event_type) AS event_type, COUNT(value) AS value, COUNT(props) AS props FROM events)
        ON event_id, ts, user_id, event_type, value, props INTO NAME column_name VALUE n_values) v USING (column_name)
    """,
)
def describe_columns(t):
    events = t("events")
    counts = events.agg(*[F.count(c).alias(c) for c in events.columns])
    per_column = counts.unpivot([], counts.columns, "column_name", "n_values")
    return relations.describe_columns(events).join(per_column, "column_name")


@query("i12_append_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def append_stream(t):
    path = new_shared_path(t.spark, "events_copy")
    stream = drivers.file_stream(t.spark, t.folder, BENCH_TABLES["events"], "events.parquet")
    drivers.append_stream(stream, f"{path}/table", f"{path}/checkpoint")
    return writers.read_table(t.spark, f"{path}/table")


@query(
    "i2_seen_key_stream",
    """
    SELECT seen_key, MIN(event_id) AS event_id FROM (
        SELECT event_id, CAST(user_id AS VARCHAR) || '|' || LOWER(event_type) AS seen_key FROM events) GROUP BY seen_key
    """,
)
def seen_key_stream(t):
    from tidemark.functions.keys import composite_key

    path = new_shared_path(t.spark, "events_seen")
    stream = drivers.file_stream(t.spark, t.folder, BENCH_TABLES["events"], "events.parquet")
    key = composite_key("user_id", "event_type")
    drivers.new_keys_stream(stream, key, "seen_key", ["event_id"], f"{path}/table", f"{path}/checkpoint")
    return writers.read_table(t.spark, f"{path}/table").select("seen_key", "event_id")
