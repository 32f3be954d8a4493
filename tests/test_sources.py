"""Readers, writers and streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import composite_key
from tidemark.operators.shaping import element_set_records
from tidemark.session import new_shared_path, shared_dir
from tidemark.sources import readers, writers
from tidemark.sources.layouts import BENCH_TABLES, SOURCE_TABLES, source_layout
from tidemark.streaming import drivers


def test_declared_tables(spark):
    assert {s: len(t) for s, t in SOURCE_TABLES.items()} == {
        "beverages": 5, "fbi": 11, "geo": 1, "gsheets": 1, "openlibrary": 4, "rick_and_morty": 6, "satellite": 1, "uv": 1, "weather": 1,
    }
    for source, tables in SOURCE_TABLES.items():
        for name in tables:
            assert source_layout(source, name).fields
    with pytest.raises(KeyError):
        source_layout("fbi", "nothing")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")


def test_versions_switch_only_when_complete(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert not writers.table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        writers.read_table(spark, path)
    writers.replace_table(spark.range(3), path)
    # The new version is computed from the one it replaces.
    writers.replace_table(writers.read_table(spark, path).where("id > 0"), path)
    assert rows(writers.read_table(spark, path)) == [(1,), (2,)]
    os.makedirs(f"{path}/v000003")  # a run that was lost before it finished
    assert writers.read_table(spark, path).count() == 2
    writers.append_table(spark.range(5, 6), path)
    assert rows(writers.read_table(spark, path)) == [(1,), (2,), (5,)]


def test_partitioned_history_prunes(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.range(10).withColumn("is_current", (F.col("id") > 6).cast("int"))
    writers.replace_table(df, path, ["is_current"])
    current = writers.read_table(spark, path).where("is_current = 1")
    assert current.count() == 3
    assert "PartitionFilters: [isnotnull(is_current" in current._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_joins_without_shuffle(spark):
    writers.save_bucketed(spark.range(100).withColumnRenamed("id", "k"), "bucketed_a", ["k"], 4)
    writers.save_bucketed(spark.range(100).withColumnRenamed("id", "k"), "bucketed_b", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


def test_view_is_lazy(spark):
    view = writers.as_view(spark.range(2).select(F.raise_error(F.lit("read")).alias("x")), "lazy_view")
    with pytest.raises(Exception, match="read"):
        view.collect()


def test_json_records_and_freshness(spark, tmp_path, rows):
    old, new = tmp_path / "old.json", tmp_path / "new.json"
    old.write_text(json.dumps({"id": 1, "at": {"lat": 1.5}}))
    new.write_text(json.dumps({"id": 2, "at": None, "extra": 1}))
    as_of = dt.datetime(2024, 1, 10)
    for file, hours in ((old, 73), (new, 71)):
        stamp = (as_of - dt.timedelta(hours=hours)).replace(tzinfo=dt.timezone.utc).timestamp()
        os.utime(file, (stamp, stamp))
    ddl = "id bigint, at struct<lat:double>"
    assert rows(readers.read_json_records(spark, str(tmp_path), ddl), "id", "at.lat") == [(1, 1.5), (2, None)]
    assert rows(readers.read_fresh_json(spark, str(tmp_path), ddl, as_of), "id") == [(2,)]


def test_element_sets_from_files(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_text("SAT A\n1 00011U\n2 x\nSAT B\n1 00012U\n2 y\n")
    (tmp_path / "b.txt").write_text("SAT C\r\n1 00013U\r\n2 z")
    got = readers.read_element_sets(spark, str(tmp_path))
    assert rows(got, "satellite_name", "satellite_id") == [("SAT A", 11), ("SAT B", 12), ("SAT C", 13)]


def test_element_sets_of_split_files(spark, tmp_path, rows):
    body = "".join(f"SAT {i} {'x' * (i % 40)}\r\n1 {i % 100000:05d}U {'y' * (i % 9)}\n2 z\n" for i in range(4000))
    texts = {"a.txt": "\n \n  " + body + " \n\n", "b.txt": "", "c.txt": " \n", "d.txt": "ONE\n1 00007U\n2 t  \nleft\nover"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    whole = spark.read.text(str(tmp_path), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    want = element_set_records(whole, "value")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = readers.read_element_sets(spark, str(tmp_path))
        lines = readers.read_numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        first = [r.line for r in lines.where("file LIKE '%a.txt'").orderBy("line_no").collect()]
        assert first == texts["a.txt"].replace("\r\n", "\n").split("\n")[:-1]
        assert rows(got, *want.columns) == rows(want) and got.count() == 4001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_source_round_trip(spark, tmp_path):
    schema = source_layout("geo", "geo_cities")
    spark.createDataFrame([(1, "Perth", -31.9, 115.8, "AU", "Australia", "WA", "08", "OC")], schema).write.parquet(str(tmp_path / "geo/geo_cities"))
    assert readers.read_source(spark, str(tmp_path), "geo", "geo_cities").first().city == "Perth"


def test_plans_push_filters_and_columns(spark):
    t = readers.Tables(spark, "/root/testdata/sf0.001")
    plan = t("lineitem").where("l_discount > 0.05").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan
    assert set(BENCH_TABLES) >= {"orders", "events"}


EVENT = "event_id bigint, uid string, status string"


def write_events(spark, path, data):
    spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(path)


def test_streams_continue_where_they_stopped(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_events(spark, source, [(1, "a", "NA"), (2, "a", "na")])
    drivers.append_stream(drivers.file_stream(spark, source, EVENT), target, state)
    drivers.append_stream(drivers.file_stream(spark, source, EVENT), target, state)
    assert spark.read.parquet(target).count() == 2
    write_events(spark, source, [(3, "b", None)])
    drivers.append_stream(drivers.file_stream(spark, source, EVENT), target, state)
    assert rows(spark.read.schema(EVENT).parquet(target), "event_id") == [(1,), (2,), (3,)]


def test_seen_keys_stream_in_batches(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    key = composite_key("uid", "status")

    def run(checkpoint=state):
        stream = drivers.file_stream(spark, source, EVENT, files_per_batch=1)
        drivers.new_keys_stream(stream, key, "seen_key", ["event_id"], target, checkpoint)

    write_events(spark, source, [(1, "a", "NA"), (2, "a", "na"), (3, "b", None)])
    run()
    write_events(spark, source, [(4, "a", "na"), (5, "b", "caught")])
    write_events(spark, source, [(6, "b", "caught"), (7, "c", "na")])
    run()
    want = [("a|na", 1), ("b|", 3), ("b|caught", 5), ("c|na", 7)]
    assert rows(spark.read.parquet(target), "seen_key", "event_id") == want
    # Replaying all batches, as after a lost checkpoint commit, adds nothing.
    run(state + "-again")
    assert rows(spark.read.parquet(target).select("seen_key").distinct()) == [(k,) for k, _ in want]
