"""Hot keys: splitting must not change results, and must split."""

import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import combinations, joins, ordering, quality, windows
from tidemark.operators.sizing import fits_broadcast, groups_fit_broadcast, measured_bytes
from tidemark.operators.skew import SALT, SLICE, hot_keys, repeat_per_salt, salt_rows, slice_hot_keys

pytestmark = pytest.mark.usefixtures("treat_as_large")


def skewed(spark, n=3000, parts=16):
    """A third of the rows have key 1, a tenth no key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 97)
    return spark.range(n).repartition(parts).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


def test_hot_keys_are_those_above_an_average_partition(spark):
    hot = {r.k: r._salts for r in hot_keys(skewed(spark), ["k"]).collect()}
    assert set(hot) == {1} or set(hot) == {1, None}
    assert hot[1] == 3  # a third of the rows in eighths, rounded up


def test_no_hot_keys(spark):
    assert hot_keys(spark.range(1000).withColumnRenamed("id", "k"), ["k"]) is None


def test_salts_spread_a_key_and_its_equal_copies(spark):
    copies = spark.range(800).repartition(16).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    salted = salt_rows(copies, hot_keys(copies, ["k"]), ["k"])
    sizes = [r["count"] for r in salted.groupBy(SALT).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 200


def test_lookup_rows_are_repeated_for_each_salt(spark):
    df = skewed(spark)
    hot = hot_keys(df, ["k"])
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, name string")
    assert repeat_per_salt(lookup, hot, ["k"]).count() == 4


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_join_equals_plain_join(spark, rows, how):
    df = skewed(spark)
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(0, 90, 2)] + [(1, "x"), (1, "y"), (None, "z")], "key bigint, name string")
    got = joins.lookup_join(df, lookup, [("k", "key")], how)
    want = df.join(lookup, df.k == lookup.key, how).drop("key")
    assert rows(got, *want.columns) == rows(want)


def test_lookup_join_on_two_columns(spark, rows):
    df = skewed(spark).withColumn("w", F.col("v") % 2)
    lookup = spark.createDataFrame([(1, 0, "even"), (1, 1, "odd"), (5, 1, "five")], "a bigint, b bigint, name string")
    got = joins.lookup_join(df, lookup, [("k", "a"), ("w", "b")])
    want = df.join(lookup, (df.k == lookup.a) & (df.w == lookup.b), "left").drop("a", "b")
    assert rows(got, *want.columns) == rows(want)


def test_relationships_keeps_every_failing_row(spark):
    child = spark.createDataFrame([(1,)] * 500 + [(2,)] * 3 + [(None,)] * 4, "k bigint").repartition(8)
    parent = spark.createDataFrame([(2,), (2,), (None,)], "k bigint")
    failing = quality.relationships(child, "k", parent, "k")
    assert failing.count() == 500


def test_size_checks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    small = spark.createDataFrame([(i, "abc") for i in range(10)], "k bigint, name string")
    assert measured_bytes(small) == 10 * (8 + 16 + 16 + 3)
    big = spark.range(100000).select("id", F.lit("abc").alias("name"))
    assert not fits_broadcast(big, big)


@pytest.mark.parametrize("rows_per_slice", [1, 7, 50])
@pytest.mark.parametrize("order", ["ts", "id_like", "day"])
def test_sliced_windows_equal_plain_windows(spark, rows, rows_per_slice, order):
    random.seed(rows_per_slice)
    data = []
    for i in range(600):
        key = random.choice(["hot", "hot", "warm", f"k{i % 40}", None])
        seconds = random.choice([0, 5, 5, random.randrange(100_000), -40_000_000])  # ties and an outlier
        data.append((key, i, seconds, float(random.randrange(100)) if i % 11 else None))
    base = spark.createDataFrame(data, "k string, i int, s int, v double").repartition(6)
    df = base.select(
        "k", "i", "v",
        F.timestamp_seconds(F.col("s")).cast("timestamp_ntz").alias("ts"),
        F.col("s").cast("double").alias("id_like"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s") / 86400).cast("int")).alias("day"),
    )
    sliced = slice_hot_keys(df, ["k"], order, rows_per_slice)
    assert sliced.where(F.col(SLICE) > 0).count() > 0
    exprs = {"mean": windows.trailing_mean("v"), "diff": windows.lag_difference("v"), "gap": windows.trailing_anomaly("v", 3)}
    got = windows.over_previous(df, ["k"], [order, "i"], ["v"], 13, exprs, rows_per_slice)
    w = Window.partitionBy("k").orderBy(order, "i")
    want = df.withColumns({name: make(w) for name, make in exprs.items()})
    assert rows(got, *want.columns) == rows(want)


def test_price_movements_with_ties(spark, rows):
    data = [(1, "A", 10.0, 0), (2, "A", 12.0, 0), (3, "A", 15.5, 60), (4, "A", 11.0, 120), (5, "B", 3.0, 0)]
    df = spark.createDataFrame(data, "id int, stock string, price double, s int").select(
        "id", "stock", "price", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts")
    )
    got = windows.price_movements(df, ["stock"], "price", "ts", "id")
    found = rows(got, "id", "price_spread", "relative_price_movement", "abs_price_movement", "num_stock_entries")
    assert found == [(1, 5.5, 2.0, 1.0, 4), (2, 5.5, 2.0, 1.0, 4), (3, 5.5, 5.5, 1.0, 4), (4, 5.5, 1.0, 1.0, 4), (5, 0.0, 0.0, 0.0, 1)]


def orderings(values, depth):
    found = list(itertools.permutations(values, min(depth, len(values))))
    return [p + (None,) * (depth - len(p)) for p in found]


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 2, "c": 7}, {"a": 8}, {"a": 3, "b": 3, "c": 3, "d": 3}])
def test_hierarchy_equals_brute_force(spark, rows, sizes):
    data = [(g, f"{g}{i}") for g, k in sizes.items() for i in range(k)]
    df = spark.createDataFrame(data + data[:1], "g string, v string").repartition(4)
    depth = 7 if max(sizes.values()) < 8 else 3
    got = rows(joins.hierarchy(df, "g", "v", depth))
    want = [(g, *p) for g, k in sizes.items() for p in orderings([f"{g}{i}" for i in range(k)], depth)]
    assert got == sorted(want, key=repr)
    assert len(got) == sum(math.factorial(k) // math.factorial(k - min(k, depth)) for k in sizes.values())
    assert quality.row_distinct(joins.hierarchy(df, "g", "v", depth), ["v", *[f"v{i}" for i in range(2, depth + 1)]]).count() == 0


def test_filters_on_levels_stay_above_their_decoding(spark, rows):
    values = [(g, f"v{i}") for g, k in (("a", 1), ("v2", 3), ("v0", 5), ("v9", 4)) for i in range(k)] + [("v1", None), (None, "v0")]
    names = ["v", *[f"v{i}" for i in range(2, 8)]]
    ordered = joins.hierarchy(spark.createDataFrame(values, "g string, v string").repartition(3), "g", "v")
    failing = quality.row_distinct(ordered, ["g", *names])
    plan = failing._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" div ") <= len(names) and "lambda" not in plan
    assert rows(failing) == sorted(((g, *p) for g, k in (("v2", 3), ("v0", 5)) for p in orderings([f"v{i}" for i in range(k)], 7)), key=repr)
    assert quality.row_distinct(ordered, names).count() == 0


def test_row_distinct_passes_missing_values(spark, rows):
    data = [("a", "b", "c"), ("a", None, "a"), (None, None, "a"), (None, None, None), ("b", "b", "b"), ("c", "a", "a"), ("c", "", "")]
    failing = quality.row_distinct(spark.createDataFrame(data, "x string, y string, z string"), ["x", "y", "z"])
    assert rows(failing) == sorted([data[1], data[4], data[5], data[6]], key=repr)
    numbers = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, float("nan")), (None, None)], "x int, y double").withColumn("z", F.col("y"))
    assert rows(quality.row_distinct(numbers, ["x", "y"])) == [(1, 1.0, 1.0)]
    assert quality.row_distinct(numbers, ["z", "x", "y"]).count() == 3


def test_hierarchy_with_missing_values(spark, rows):
    df = spark.createDataFrame([("g", None), ("g", "x"), (None, "y"), (None, "z")], "g string, v string")
    assert rows(joins.hierarchy(df, "g", "v", 2)) == sorted([("g", None, None), ("g", "x", None), (None, "y", None), (None, "z", None)], key=repr)


def test_star_fanout_equals_left_joins(spark, rows):
    random.seed(5)
    keys = ["hot", *[f"k{i}" for i in range(30)]]
    spine = spark.createDataFrame([(k,) for k in keys], "k string")
    children, plain = {}, spine
    for name, most in (("a", 40), ("b", 12), ("c", 2)):
        data = [(k, f"{name}{k}{i}") for k in keys for i in range(most if k == "hot" else random.randrange(3))]
        child = spark.createDataFrame(data + [("absent", "q")], "owner string, value string").repartition(5)
        children[name] = (child, "owner", "value")
        plain = plain.join(child.select(F.col("owner").alias("k"), F.col("value").alias(name)), "k", "left")
    got = joins.star_fanout(spine, "k", children)
    assert rows(got) == rows(plain)
    assert got.where("k = 'hot'").count() == 40 * 12 * 2


def test_hierarchy_is_decoded_in_ranges(spark, rows, monkeypatch):
    monkeypatch.setattr(combinations, "RANKS_AT_ONCE", 100)
    df = spark.createDataFrame([("g", f"v{i}", "n") for i in range(7)] + [("h", "x", "n"), ("g", None, "n"), (None, "y", "n")], "g string, v string, n string")
    names = ["v", *[f"v{i}" for i in range(2, 6)]]
    got = joins.hierarchy(df, "g", "v", 5)
    want = [("g", *p) for p in orderings([f"v{i}" for i in range(7)], 5)]
    want += [("h", "x", *[None] * 4), ("g", *[None] * 5), (None, "y", *[None] * 4)]
    assert rows(got) == sorted(want, key=repr)
    assert sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())[-1] < 0.4 * len(want)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    carried = joins.hierarchy(df, "g", "v", 5, carry=["n"])
    assert rows(carried, "g", *names) == sorted(want, key=repr) and carried.columns == ["g", "n", *names]


def test_hot_child_in_one_partition_spreads(spark, rows):
    spine = spark.createDataFrame([("hot",), ("cold",), ("none",)], "k string")
    one_place = spark.range(0, 3000, 1, 1).select(F.lit("hot").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT 'cold', 5L"))
    equal = spark.range(0, 40, 1, 1).select(F.lit("hot").alias("k"), F.lit("same").alias("v"))
    got = joins.star_fanout(spine, "k", {"a": (one_place, "k", "v"), "b": (equal, "k", "v")})
    want = [("hot", i, "same") for i in range(3000) for _ in range(40)] + [("cold", 5, None), ("none", None, None)]
    assert rows(got) == sorted(want, key=repr)
    per_task = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert len(per_task) > 4 and per_task[-1] < 0.45 * len(want)
    # copies of one row are cut as well
    copies = spark.range(0, 4000, 1, 1).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    got = joins.star_fanout(spine, "k", {"a": (copies, "k", "v"), "b": (equal, "k", "v")})
    assert got.where("k = 'hot'").count() == 160_000
    assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) < 80_000


def test_few_groups_of_many_rows_are_broadcast(spark, rows):
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 10).alias("k"), F.concat(F.lit("name"), F.col("id") % 3).alias("s"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        got = windows.partition_values(df, ["k", "s"], spread=F.max("v") - F.min("v"), n=F.count("v"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        many = windows.partition_values(df.withColumn("k", F.col("v")), ["k"], n=F.count("v"), text=F.max("s"))
        assert many.where("n = 1").count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    whole = Window.partitionBy("k", "s")
    assert rows(got) == rows(df.withColumn("spread", F.max("v").over(whole) - F.min("v").over(whole)).withColumn("n", F.count("v").over(whole)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Sort [" not in plan


def test_groups_beyond_the_limit_are_not_broadcast(spark):
    df = spark.range(200_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    counted = df.groupBy("k").count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert not groups_fit_broadcast(df, ["k"], counted)
        assert groups_fit_broadcast(df.where("k < 9000"), ["k"], counted)
        assert not groups_fit_broadcast(df.where("k < 20000"), ["s"], df.groupBy("s").count())
        assert not groups_fit_broadcast(df, ["k"], df.groupBy("k").agg(F.max("s")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_peers_of_one_instant_fill_no_window(spark, rows, treat_as_large):
    df = spark.createDataFrame([(k, t, i, float(i * 7 % 11)) for i, (k, t) in enumerate([("a", 1)] * 40 + [("a", 2), ("b", None), ("b", None), (None, 3), (None, 3), ("b", 4)])], "k string, t int, i int, v double")
    got = windows.with_peer_last(df, "last", "v", ["k"], "t", "i")
    want = df.withColumn("last", F.max_by("v", "i").over(Window.partitionBy("k", "t")))
    assert rows(got) == rows(want)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_splits(spark, treat_as_large):
    """Large for the size checks, while written files are still read in a few splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")


@pytest.mark.parametrize("with_used", [True, False])
def test_quota_by_ranges_equals_ranks(spark, rows, small_splits, with_used):
    hot = F.when(F.col("id") % 3 == 0, F.lit(None).cast("int")).when(F.col("id") % 3 == 1, 1).otherwise((F.col("id") % 7).cast("int"))
    df = spark.range(0, 12_000, 1, 6).select(hot.alias("day"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("t"), F.col("id").alias("i"))
    used = spark.createDataFrame([(1, 1500), (2, 9999), (3, -3)], "day int, used int") if with_used else None
    got = ordering.quota_by_ranges(df, "day", ["t", F.col("i").desc()], 2000, used)
    rank = F.row_number().over(Window.partitionBy("day").orderBy("t", F.col("i").desc()))
    want = df.withColumn("r", rank)
    if with_used:
        want = want.join(used, "day", "left").withColumn("r", F.col("r") + F.coalesce("used", F.lit(0)))
    assert rows(got) == rows(want.where("r <= 2000"), *df.columns) and got.columns == df.columns
    # all orders equal: ranges still split the day
    same = ordering.quota_by_ranges(df.withColumn("t", F.lit(1)), "day", ["t"], 2000)
    assert rows(same.groupBy("day").count()) == rows(df.groupBy("day").count().select("day", F.least("count", F.lit(2000))))


def test_large_quotas_take_ranges(spark, rows, small_splits):
    df = spark.range(0, 5000, 1, 4).select(F.lit("d").alias("day"), "id")
    got = ordering.quota_cap(df, "day", ["id"], 3000)
    assert rows(got, "id") == rows(spark.range(3000)) and "_range" in got._jdf.queryExecution().analyzed().toString()
    assert ordering.quota_cap(df, "day", ["id"], 30).count() == 30


def test_salts_spread_rows_that_lie_together(spark):
    together = skewed(spark).repartition(8, "k")
    salted = salt_rows(together, hot_keys(together, ["k"]), ["k"]).where("k = 1")
    sizes = [r["count"] for r in salted.groupBy(SALT).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 2 * min(sizes)


def test_lookup_join_refuses_joins_that_keep_lookup_rows(spark):
    with pytest.raises(ValueError, match="lookup_join"):
        joins.lookup_join(skewed(spark), spark.range(3).withColumnRenamed("id", "key"), [("k", "key")], "right")


def test_windows_with_missing_and_text_order(spark, rows):
    df = spark.range(400).select(
        F.lit("a").alias("k"), F.when(F.col("id") % 50 != 0, F.col("id") * 7 % 400).alias("t"), F.col("id").alias("i"), F.col("id").cast("double").alias("v")
    )
    df = df.withColumn("s", F.lpad(F.col("t").cast("string"), 4, "0"))
    for order in (["t", "i"], ["s", "i"]):
        plain = Window.partitionBy("k").orderBy(*order)
        want = df.withColumn("m", F.avg("v").over(plain.rowsBetween(-13, 0))).withColumn("d", F.lag("v").over(plain))
        got = windows.over_previous(df, ["k"], order, ["v"], 13, {"m": windows.trailing_mean("v"), "d": lambda w: F.lag("v").over(w)})
        assert rows(got, "i", "m", "d") == rows(want, "i", "m", "d")


def test_many_uniqueness_checks_share_one_shuffle(spark, rows):
    data = [(1, "x", None), (1, "x", None), (1, "y", 2.0), (2, None, 2.0), (2, None, None), (None, "z", 3.0), (None, "z", 3.0)]
    df = spark.createDataFrame(data, "a int, b string, c double").repartition(3)
    checks = [
        quality.UniqueCheck("a", ("a",), ignore_nulls=True),
        quality.UniqueCheck("a with nulls", ("a",), "warn"),
        quality.UniqueCheck("a and b", ("b", "a")),
        quality.UniqueCheck("c", ("c",), ignore_nulls=True),
        quality.UniqueCheck("all", ("a", "b", "c")),
    ]
    got = quality.run_checks(df, unique_checks=checks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    want = [quality.unique(df, "a"), quality.unique_combination(df, ["a"]), quality.unique_combination(df, ["a", "b"]), quality.unique(df, "c"), quality.unique_combination(df, ["a", "b", "c"])]
    assert rows(got) == sorted([(c.name, c.severity, w.count()) for c, w in zip(checks, want, strict=True)], key=repr)
    assert {r.failures for r in quality.run_checks(df.where("1 = 0"), unique_checks=checks).collect()} == {0}
