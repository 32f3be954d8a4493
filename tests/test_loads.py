"""Shaping, load dispositions, incremental state and history, run after run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, history, incremental, loading, ordering, relations, shaping
from tidemark.plans import beverages, finance, library, satellite, universities, wanted
from tidemark.sources.layouts import source_layout

D = dt.date
NOW = dt.datetime(2024, 5, 1, 12)


def ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Shaping


def test_snake_case():
    names = ["strGlass", "DateTime", "City", "idDrink", "strIngredient1", "HTTPStatus", "already_snake", "with space"]
    assert [shaping.snake_case(n) for n in names] == [
        "str_glass", "date_time", "city", "id_drink", "str_ingredient1", "http_status", "already_snake", "with_space",
    ]


def test_snake_case_collision(spark):
    with pytest.raises(ValueError):
        shaping.snake_case_columns(spark.createDataFrame([(1, 2)], "strName int, str_name int"))


def test_child_tables(spark, rows):
    df = spark.createDataFrame([("r1", ["a", None, ""]), ("r2", []), ("r3", None)], "_dlt_id string, tags array<string>")
    child = shaping.explode_child(df, "_dlt_id", "tags")
    assert rows(child, "value", "_dlt_list_idx", "_dlt_root_id") == [("", 2, "r1"), ("a", 0, "r1"), (None, 1, "r1")]
    assert child.select("_dlt_id").distinct().count() == 3
    assert rows(child) == rows(shaping.explode_child(df, "_dlt_id", "tags"))


def test_pluck_takes_first_list_of_records(spark, rows):
    docs = [
        ('{"n": 1, "ids": [1, 2], "drinks": [{"s": "a"}, {"t": "x"}, {"s": null}], "more": [{"s": "no"}]}',),
        ('{"empty": [], "drinks": [{"s": "z"}]}',),
        ("not json",),
        (None,),
    ]
    df = spark.createDataFrame(docs, "doc string")
    assert rows(shaping.pluck_records(df, "doc", "s", "name"), "name") == [("a",), (None,)]


def test_element_sets(spark, rows):
    text = "\nISS (ZARYA)  \r\n1 25544U 98067A\r\n2 25544 51.6\nNOAA 15\n1 A0001U\n2 x\nleft over\n"
    df = spark.createDataFrame([("f", text), ("g", "only one line"), ("h", "")], "file string, value string")
    got = rows(shaping.element_set_records(df, "value"), "file", "record_no", "satellite_name", "satellite_id")
    assert got == [("f", 0, "ISS (ZARYA)", 25544), ("f", 1, "NOAA 15", None)]


def test_subjects(spark, rows):
    data = [("/works/OL1W", ["a", "", None, "a"], None), ("/authors/OL2A", ["b"], None), ("/works/OL3W", None, "timeout")]
    works = spark.createDataFrame(data, "key string, subjects array<string>, error string")
    good, failed = library.subjects(works)
    assert rows(good) == [("OL1W", "a")]
    assert rows(failed) == [("/works/OL3W", "timeout")]


# Load dispositions


def test_merge_is_repeatable_and_last_load_wins(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "id int, v string")
    updates = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "new", 1)], "id int, v string, seq int")
    once = loading.merge_upsert(target, updates, ["id"], ["seq"])
    assert rows(once) == [(1, "last"), (2, "kept"), (3, "new")]
    assert rows(loading.merge_upsert(once, updates, ["id"], ["seq"])) == rows(once)


def test_dimension_load_tags_and_merges(spark, rows):
    stored = spark.createDataFrame([("1", "Old"), ("9", "Kept")], source_layout("beverages", "glass_table"))
    extracts = {v: spark.createDataFrame([(i,)], "id_drink string") for v, i in (("Mug", "1"), ("Jar", "2"))}
    got = beverages.load_dimension("glass_table", extracts, stored)
    assert rows(got) == [("1", "Mug"), ("2", "Jar"), ("9", "Kept")]


def test_universities(spark, rows):
    ca = spark.createDataFrame([("u1",), ("u2",)], "name string")
    records, failed, totals = universities.load(spark, {"Canada": ca, "Australia": None})
    assert records.count() == 2 and rows(failed) == [("Australia",)] and rows(totals) == [(2, 1)]
    nothing, failed, _ = universities.load(spark, {"Canada": None})
    assert nothing is None and failed.count() == 1


# Incremental state


def state_row(spark, latest):
    rows = [(latest, NOW, 5, "success")] if latest else []
    return ntz(spark.createDataFrame(rows, "latest_ts timestamp, last_run timestamp, processed_records bigint, last_run_status string"), "latest_ts", "last_run")


@pytest.mark.parametrize(
    "latest, n, status",
    [
        (None, 2, "success"),
        (dt.datetime(2024, 1, 1, 9, 30), 0, "skipped_no_new_data"),  # exactly thirty minutes
        (dt.datetime(2024, 1, 1, 9, 29, 59), 2, "success"),
        (dt.datetime(2025, 1, 1), 0, "skipped_no_new_data"),
    ],
)
def test_watermark_gate(spark, latest, n, status):
    batch = ntz(spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 8)), (2, dt.datetime(2024, 1, 1, 10))], "id int, t timestamp"), "t")
    accepted, state = incremental.watermark_gate(batch, state_row(spark, latest), "t", NOW)
    assert accepted.count() == n
    row = state.first()
    assert row.last_run_status == status and row.last_run == NOW
    again, state2 = incremental.watermark_gate(batch, state, "t", NOW)
    assert again.count() == 0 and state2.first().last_run_status == "skipped_no_new_data"
    assert state2.first().latest_ts == row.latest_ts and state2.first().processed_records == row.processed_records


def test_finance_load(spark, rows):
    prices = "id bigint, stock string, price double, date_time timestamp"
    stored = ntz(spark.createDataFrame([(1, "A", 1.0, dt.datetime(2024, 1, 1))], prices), "date_time")
    batch = ntz(spark.createDataFrame([(1, "A", 2.0, dt.datetime(2024, 1, 2)), (2, "B", 3.0, dt.datetime(2024, 1, 2))], prices), "date_time")
    table, state = finance.load(batch, stored, state_row(spark, dt.datetime(2024, 1, 1)), NOW)
    assert rows(table, "id", "price") == [(1, 2.0), (2, 3.0)]
    assert rows(finance.load(batch, table, state, NOW)[0], "id", "price") == [(1, 2.0), (2, 3.0)]


def wanted_rows(spark, *people):
    layout = source_layout("fbi", "wanted")
    return spark.createDataFrame([[p.get(f.name) for f in layout.fields] for p in people], layout)


def test_seen_keys_accept_a_new_status(spark, rows):
    first = wanted_rows(spark, {"uid": "a", "status": "NA", "title": "one"}, {"uid": "b"})
    none = first.limit(0)
    seen = spark.createDataFrame([], "seen_key string")
    table, seen = wanted.load(first, seen, none)
    assert rows(seen) == [("a|na|",), ("b||",)]
    again, seen2 = wanted.load(first.withColumn("title", F.lit("changed")), seen, table)
    assert rows(again, "uid", "title") == [("a", "one"), ("b", None)] and rows(seen2) == rows(seen)
    caught = wanted_rows(spark, {"uid": "a", "status": "captured", "title": "two"})
    table3, seen3 = wanted.load(caught, seen, table)
    assert rows(table3, "uid", "title") == [("a", "two"), ("b", None)] and seen3.count() == 3
    # An emptied table is loaded again although the keys were seen.
    assert wanted.load(first, seen, none)[0].count() == 2


def test_gap_plan(spark, rows):
    cities = spark.createDataFrame([("absent",), ("full",), ("behind",), ("late",), ("short",)], "city string")
    loaded = spark.createDataFrame(
        [("full", D(2024, 1, 1)), ("full", D(2024, 1, 10)), ("behind", D(2024, 1, 1)), ("behind", D(2024, 1, 9)),
         ("late", D(2024, 1, 5)), ("late", D(2024, 1, 12)), ("short", D(2023, 1, 1))],
        "city string, day date",
    )
    plan = {r[0]: tuple(r)[1:] for r in incremental.gap_plan(cities, loaded, "city", "day", D(2024, 1, 1), D(2024, 1, 10)).collect()}
    assert plan["absent"] == ("new", D(2024, 1, 1), D(2024, 1, 10))
    assert plan["full"] == ("skipped", None, None)
    assert plan["behind"] == ("update", D(2024, 1, 10), D(2024, 1, 10))
    assert plan["late"] == ("skipped", None, None)
    assert plan["short"] == ("update", D(2024, 1, 1), D(2024, 1, 10))


def test_missing_pairs_feed_back(spark, rows):
    users = spark.createDataFrame([("x",), ("y",)], "who string")
    have = spark.createDataFrame([("x", D(2024, 1, 2))], "who string, day date")
    first = incremental.missing_pairs(users, have, "who", "day", D(2024, 1, 1), D(2024, 1, 2), batch=2)
    assert [tuple(r) for r in first.collect()] == [(D(2024, 1, 2), "y"), (D(2024, 1, 1), "x")]
    second = incremental.missing_pairs(users, have.unionByName(first.select("who", "day")), "who", "day", D(2024, 1, 1), D(2024, 1, 2))
    assert rows(second) == [(D(2024, 1, 1), "y")]


def test_quota_skips_unknown_first(spark, rows):
    day = D(2024, 1, 1)
    requests = spark.createDataFrame([(day, c, i) for i, c in enumerate(["q", "a", "b", "c", "a"])], "day date, city string, i int")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "city string")
    used = spark.createDataFrame([(day, 1)], "day date, used bigint")
    assert rows(ordering.quota_cap(requests, "day", ["i"], 3, used, known, "city"), "i") == [(1,), (2,)]
    over = spark.createDataFrame([(day, 9)], "day date, used bigint")
    assert ordering.quota_cap(requests, "day", ["i"], 3, over, known, "city").count() == 0


def test_suppression_tolerance(spark, rows):
    layout = "satellite_id bigint, satellite_name string, timestamp timestamp_ntz, tle_line1 string, tle_line2 string, x_km double, y_km double, z_km double, distance_km double"
    stored = spark.createDataFrame([(1, "s", NOW, "", "", 1.0, 2.0, 3.0, None), (2, "s", NOW, "", "", 0.0, 0.0, 0.0, None)], layout)
    current = spark.createDataFrame(
        [(1, "s", NOW, "", "", 1.0 + 5e-7, 2.0, 3.0, None), (2, "s", NOW, "", "", 5e-6, 0.0, 0.0, None), (3, "s", NOW, "", "", 1.0, 1.0, 1.0, None), (4, "s", NOW, "", "", 0.0, 0.0, 0.0, None)], layout
    ).withColumn("error_code", F.when(F.col("satellite_id") == 4, 1).otherwise(0))
    table, judged = satellite.load(current, stored)
    assert rows(judged) == [(1, "skipped"), (2, "success"), (3, "firstrun"), (4, "failed")]
    assert rows(table, "satellite_id", "distance_km") == [(2, 5e-6), (3, None)]


@pytest.mark.parametrize(
    "statuses, any_success, not_all_bad, need_success",
    [
        (["success", "failed"], "load", "load", "load"),
        (["skipped", "skipped_no_new_data"], "skip", "skip", "skip"),
        (["failed", "failed"], "error", "error", "error"),
        (["failed", "skipped"], "error", "load", "skip"),
        (["firstrun"], "load", "load", "load"),
        ([], "skip", "skip", "skip"),
        ([None, "success"], "load", "load", "load"),
    ],
)
def test_status_rollup(spark, statuses, any_success, not_all_bad, need_success):
    df = spark.createDataFrame([(s,) for s in statuses], "s string")
    row = df.agg(*[aggregates.decision("s", r).alias(r) for r in aggregates.RULES]).first()
    assert tuple(row) == (any_success, not_all_bad, need_success)


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "DateTime int")
    assert incremental.required_columns_gate(df, ["DateTime"]).first()[0] == "ready"
    assert incremental.required_columns_gate(df, ["Price"]).first()[0] == "skipped_missing_price"
    assert incremental.required_columns_gate(df.limit(0), ["DateTime"]).first()[0] == "skipped_empty_data"


# History


def glasses(spark, **by_id):
    return spark.createDataFrame(list(by_id.items()), "id_drink string, source_glass string") if by_id else spark.createDataFrame([], "id_drink string, source_glass string")


def check_intervals(h, key):
    assert open_per_key(h, key) <= 1
    overlaps = h.alias("a").join(h.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}")).where(
        (F.col("a.dbt_scd_id") != F.col("b.dbt_scd_id"))
        & (F.col("a.dbt_valid_from") < F.coalesce("b.dbt_valid_to", F.lit("9999-01-01").cast("timestamp_ntz")))
        & (F.col("b.dbt_valid_from") < F.coalesce("a.dbt_valid_to", F.lit("9999-01-01").cast("timestamp_ntz")))
    )
    assert overlaps.count() == 0


def open_per_key(h, key):
    return history.open_rows(h).groupBy(key).count().agg(F.max("count")).first()[0] or 0


def test_glass_changed_removed_and_back(spark, rows):
    runs = [dt.datetime(2024, m, 1) for m in (1, 2, 3, 4, 5)]
    states = [{"1": "Mug", "2": "Jar"}, {"1": "Cup", "2": "Jar"}, {"2": "Jar"}, {"1": "Cup", "2": "Jar"}, {"1": "Cup", "2": "Jar"}]
    h = None
    for run, state in zip(runs, states):
        h = beverages.glass_type_snapshot(h, glasses(spark, **state), run)
        check_intervals(h, "beverage_id")
    got = rows(h.where("beverage_id = '1'"), "glass_type", "dbt_valid_from", "dbt_valid_to")
    assert got == sorted([("Mug", runs[0], runs[1]), ("Cup", runs[1], runs[2]), ("Cup", runs[3], None)], key=repr)
    assert rows(h.where("beverage_id = '2'"), "dbt_valid_from", "dbt_valid_to") == [(runs[0], None)]
    assert rows(history.as_of(h, runs[2]), "beverage_id", "glass_type") == [("2", "Jar")]


def test_null_is_a_value_in_history(spark, rows):
    layout = "pk string, fbi_status string"
    first = history.first_snapshot(spark.createDataFrame([("a", None), ("b", "na"), ("c", None)], layout), ["pk"], history.instant(NOW))
    later = dt.datetime(2024, 6, 1)
    h = history.scd2_check(first, spark.createDataFrame([("a", None), ("b", None), ("c", "na")], layout), ["pk"], ["fbi_status"], later)
    assert rows(history.open_rows(h), "pk", "fbi_status") == sorted([("a", None), ("b", None), ("c", "na")], key=repr)
    assert h.count() == 5


def test_timestamp_history_ignores_older_and_keeps_missing(spark, rows):
    layout = "id int, v string, t timestamp_ntz"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    h = history.first_snapshot(spark.createDataFrame([(1, "a", t1), (2, "b", t2), (3, "c", t1)], layout), ["id"], F.col("t"))
    h = history.scd2_timestamp(h, spark.createDataFrame([(1, "a2", t2), (2, "older", t1)], layout), ["id"], "t", NOW)
    assert rows(history.open_rows(h), "id", "v") == [(1, "a2"), (2, "b"), (3, "c")]
    assert rows(h.where("dbt_valid_to is not null"), "v", "dbt_valid_to") == [("a", t2)]


# Relations


def test_union_and_inline(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2, "y")], "m int, t string")
    assert rows(relations.union_all([a, b])) == [(1, "x"), (2, "y")]
    assert relations.inline_rows(spark, [], "a string").count() == 0
    assert relations.row_counts({"a": a, "none": a.limit(0)}).where("row_count = 0").first().table_name == "none"
