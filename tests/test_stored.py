"""Stored tables: whole commits, merges and histories that rewrite little, streams that run exactly once."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import composite_key
from tidemark.operators import history, loading, stored
from tidemark.sources import stored as log
from tidemark.sources.stored import CommitConflict, StoredTable
from tidemark.streaming import drivers

RUNS = [dt.datetime(2024, m, 1) for m in (1, 2, 3, 4)]


def files_on_disk(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_append_is_whole_or_nothing(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(spark.range(3))
    fails = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error("lost").cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.append(fails)
    assert rows(table.read()) == [(0,), (1,), (2,)]
    # a run that wrote its files and was lost before its entry
    table.write(spark.range(7, 9), table.state())
    assert rows(table.read()) == [(0,), (1,), (2,)]
    table.append(spark.range(5, 6).withColumn("more", F.lit("x")))
    assert rows(table.read()) == [(0, None), (1, None), (2, None), (5, "x")]
    assert rows(table.read(version=1)) == [(0,), (1,), (2,)]
    with pytest.raises(TypeError):
        table.append(spark.sql("SELECT 'text' AS id"))
    table.append(spark.range(0))
    assert table.read().count() == 4


def test_replace_reads_what_it_replaces(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.append(spark.range(4))
    table.replace(table.read().where("id > 1"))
    assert rows(table.read()) == [(2,), (3,)] and rows(table.read(version=1)) == [(0,), (1,), (2,), (3,)]
    assert table.expire(older_than_ms=3_600_000) == 0
    assert table.expire(older_than_ms=0) == 1 and rows(table.read()) == [(2,), (3,)]


def test_writers_cannot_take_one_number(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.append(spark.range(1))
    old = table.state()
    table.append(spark.range(1, 2))
    schema = old.struct()
    assert table.commit(old, schema, table.write(spark.range(2, 3), old)) == 3  # adds only: the next number
    with pytest.raises(CommitConflict):
        table.commit(old, schema, [], old.files)  # takes out what another commit may have read
    assert rows(table.read()) == [(0,), (1,), (2,)]


def test_state_is_kept_whole_now_and_then(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(log, "WHOLE_EVERY", 3)
    table = StoredTable(spark, str(tmp_path / "t"))
    for k in range(7):
        table.append(spark.range(k, k + 1).coalesce(1), "w", k, [f"file{k}"])
    assert table.append(spark.range(9), "w", 6) is None
    for name in ("000000000001.json", "000000000002.json"):
        os.remove(tmp_path / "t" / "_log" / name)
    state = table.state()
    assert rows(table.read()) == [(k,) for k in range(7)] and state.batches == {"w": 6} and len(state.sources) == 7


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"), ["k"], 8)
    first = spark.range(400).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    assert stored.merge_stored(table, first, ["k"]) == list(range(8))
    before = files_on_disk(table.path)
    live = table.state().files
    update = spark.createDataFrame([(7, 1, 1), (7, 2, 2)], "k int, v int, seq int")
    (bucket,) = stored.merge_stored(table, update, ["seq"])
    assert {p: t for p, t in files_on_disk(table.path).items() if p in before} == before
    after = table.state().files
    assert all(f.bucket == bucket for p, f in after.items() if p not in live)
    assert {f.bucket for p, f in live.items() if p not in after} == {bucket}
    want = loading.merge_upsert(first, update.selectExpr("CAST(k AS BIGINT) AS k", "v", "seq"), ["k"], ["seq"])
    assert rows(table.read()) == rows(want)
    assert stored.merge_stored(table, update.limit(0), ["seq"]) == [] and table.state().version == 2
    plan = table.read(buckets=[bucket]).inputFiles()
    assert plan and all(f"/bucket={bucket}/" in p for p in plan)
    with pytest.raises(ValueError):
        stored.merge_stored(StoredTable(spark, str(tmp_path / "u")), update, ["seq"])


def test_merge_of_null_keys_and_hot_updates(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"), ["a", "b"], 4)
    one = [(None, "x", 1), (1, None, 2), (1, "x", 3)]
    stored.merge_stored(table, spark.createDataFrame(one, "a int, b string, v int"), ["v"])
    many = spark.createDataFrame([(None, "x", v) for v in range(10, 500)], "a int, b string, v int")
    stored.merge_stored(table, many, ["v"])
    assert rows(table.read()) == sorted([(None, "x", 499), (1, None, 2), (1, "x", 3)], key=repr)


EXTRACTS = [
    [(k, "a") for k in range(200)] + [(None, "n")],
    [(k, "b" if k == 3 else "a") for k in range(200) if k != 4] + [(None, "n")],
    [(k, "b" if k == 3 else "a") for k in range(201)] + [(None, "m")],
    [(k, "b" if k == 3 else "a") for k in range(201)] + [(None, "m")],
]


@pytest.mark.parametrize("hard_deletes", [True, False])
def test_history_rewrites_changed_buckets_and_no_closed_row(spark, tmp_path, rows, hard_deletes):
    table = StoredTable(spark, str(tmp_path / "h"), ["k"], 16)
    want, closed, touched = None, set(), []
    for data, now in zip(EXTRACTS, RUNS, strict=True):
        current = spark.createDataFrame(data, "k int, s string")
        before = files_on_disk(table.path)
        touched.append(stored.scd2_check_stored(table, current, ["s"], now, hard_deletes))
        if want is None:
            want = history.first_snapshot(current, ["k"], history.instant(now))
        else:
            want = history.scd2_check(want, current, ["k"], ["s"], now, hard_deletes)
        want = spark.createDataFrame(want.collect(), want.schema)
        assert rows(table.read()) == rows(want)
        assert {p: t for p, t in files_on_disk(table.path).items() if p in before} == before
        live = table.state().files
        assert closed <= set(live)  # a closed row's file stays
        closed = {p for p, f in live.items() if f.tag == stored.CLOSED}
    assert touched[0] and 0 < len(touched[1]) <= 2 and touched[3] == []
    assert rows(table.read(tags=[stored.OPEN])) == rows(history.open_rows(want))


def test_timestamp_history_stored(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "h"), ["k"], 4)
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]
    frames = [spark.createDataFrame([(1, times[0]), (2, times[i])], "k int, at string").withColumn("at", F.col("at").cast("timestamp_ntz")) for i in (0, 1)]
    for f in frames:
        stored.scd2_timestamp_stored(table, f, "at", RUNS[3])
    want = history.scd2_timestamp(history.first_snapshot(frames[0], ["k"], F.col("at")), frames[1], ["k"], "at", RUNS[3])
    assert rows(table.read()) == rows(want)


EVENT = "event_id bigint, uid string, status string"


def write_events(spark, path, ids):
    spark.createDataFrame([(i, f"u{i}", "na") for i in ids], EVENT).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("kind", ["append", "new_keys"])
def test_fresh_checkpoint_over_an_old_target(spark, tmp_path, rows, kind):
    target = str(tmp_path / "out")

    def run(source, checkpoint):
        stream = drivers.file_stream(spark, str(tmp_path / source), EVENT, files_per_batch=1)
        if kind == "append":
            drivers.append_stream(stream, target, str(tmp_path / checkpoint))
        else:
            drivers.new_keys_stream(stream, composite_key("uid", "status"), "seen_key", ["event_id"], target, str(tmp_path / checkpoint))
        return sorted(r.event_id for r in StoredTable(spark, target).read().collect())

    write_events(spark, str(tmp_path / "in"), range(10))
    write_events(spark, str(tmp_path / "other"), range(10, 20))
    assert run("in", "state") == list(range(10))
    assert run("other", "state-2") == list(range(20))  # nothing lost or overwritten
    write_events(spark, str(tmp_path / "in"), range(20, 25))
    assert run("in", "state-3") == list(range(25))  # nothing repeated
    assert run("in", "state") == list(range(25))


def test_batch_that_comes_again_adds_nothing(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_events(spark, source, range(3))
    drivers.append_stream(drivers.file_stream(spark, source, EVENT), target, state)
    # the sink's commit stands, the stream's own note of it is lost
    for folder, _, names in os.walk(os.path.join(state, "commits")):
        for name in names:
            os.remove(os.path.join(folder, name))
    drivers.append_stream(drivers.file_stream(spark, source, EVENT), target, state)
    assert rows(StoredTable(spark, target).read(), "event_id") == [(0,), (1,), (2,)]


def test_stream_of_no_files(spark, tmp_path):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).option("numPartitions", 1).load()
    with_id = stream.selectExpr("value AS event_id")
    target = str(tmp_path / "out")
    query_rows = []

    def once(batch, table):
        query_rows.append(batch.count())
        return batch

    drivers.commit_batches(with_id, once, target, str(tmp_path / "state"))
    assert StoredTable(spark, target).read().count() == sum(query_rows) > 0
