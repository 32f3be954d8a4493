"""Compare plain and split plans on generated rows of which a third share one key.

    python tools/skew_trial.py [--rows 20000000]

Prints per case the wall time and the longest task of the plan, which is what a
hot key costs on a cluster.
"""

from __future__ import annotations

import argparse
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import windows  # noqa: E402
from tidemark.operators.joins import lookup_join  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--rows", type=int, default=20_000_000)
    args = parser.parse_args()
    conf = {"spark.sql.shuffle.partitions": "32", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("skew", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    n = args.rows
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.xxhash64("id") % 500_000)
    when = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30_000_000)))
    rows = spark.range(n).select(key.alias("k"), when.cast("timestamp_ntz").alias("ts"), F.col("id"), F.rand(1).alias("v"), F.md5(F.col("id").cast("string")).alias("note"))
    rows.repartition(32).write.parquet(f"{folder}/rows")
    names = spark.range(-500_000, 500_000).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("name"))
    names.write.parquet(f"{folder}/names")
    rows, names = spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/names")
    maximum = spark.sparkContext._gateway.new_array(spark._jvm.double, 1)
    maximum[0] = 1.0
    tracker = spark.sparkContext._jsc.sc().statusStore()

    def run(label, build):
        before = max((s.stageId() for s in stages()), default=-1)
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        seconds = time.time() - start
        longest = 0
        for s in stages():
            if s.stageId() > before and s.status().toString() == "COMPLETE":
                q = tracker.taskSummary(s.stageId(), s.attemptId(), maximum)
                if q.isDefined():
                    longest = max(longest, q.get().executorRunTime().apply(0) / 1000)
        print(f"{label:24} {seconds:7.1f}s  longest task {longest:7.1f}s", flush=True)

    def stages():
        found = tracker.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return [found.apply(i) for i in range(found.size())]

    w = Window.partitionBy("k").orderBy("ts", "id")
    exprs = {"mean": windows.trailing_mean("v"), "diff": windows.lag_difference("v")}
    whole = Window.partitionBy("k")
    run("warm up", lambda: rows.groupBy("k").count())
    run("window, plain", lambda: rows.withColumns({c: make(w) for c, make in exprs.items()}))
    run("window, sliced", lambda: windows.over_previous(rows, ["k"], ["ts", "id"], ["v"], 13, exprs))
    run("partition values, plain", lambda: rows.withColumn("spread", F.max("v").over(whole) - F.min("v").over(whole)))
    run("partition values, joined", lambda: windows.partition_values(rows, ["k"], spread=F.max("v") - F.min("v")))
    run("lookup, plain", lambda: rows.join(names, rows.k == names.key, "left"))
    run("lookup, salted", lambda: lookup_join(rows, names, [("k", "key")]))


if __name__ == "__main__":
    main()
