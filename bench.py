"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [--duckdb] [--runs 3] [name part ...]

Each query is built and fully computed (a sink that drops the rows) once to warm
up, then ``runs`` times; the median counts. ``--duckdb`` also times the matching SQL.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import statistics
import sys
import time

from tidemark import catalog
from tidemark.session import build_session
from tidemark.sources.layouts import BENCH_TABLES
from tidemark.sources.readers import Tables

HEADLINE = [
    "flagship_series_report",
    "p5_casts",
    "p8_case_regex",
    "p9_case_ilike",
    "f6_surrogate_key",
    "f9_zone_shift",
    "f12_calendar",
    "f15_market_hours",
    "f17_round_binary",
    "j1_lookup_left_join",
    "j2_child_to_root",
    "j3_star_fanout",
    "j4_hierarchy",
    "j7_missing_pairs",
    "j9_aggregate_lookup",
    "a2_distinct",
    "a3_grouped_count",
    "a7_row_repeats",
    "a8_last_values",
    "a9_status_rollup",
    "w1_partition_spread",
    "w2_running_last_minus_first",
    "w5_trailing_mean",
    "w5_trailing_mean_hot_keys",
    "w7_lag_difference",
    "o2_top_n",
    "o3_quota_cap",
    "u3_columns_to_rows",
    "u6_year_chunks",
    "s5_merge_upsert",
    "s10_scalar_child_table",
    "s16_stride_records",
    "i2_filter_unseen",
    "i4_gap_plan",
    "i5_missing_pairs",
    "i8_scd2_hard_deletes",
    "q2_unique",
    "q4_relationships",
    "q_run_checks",
    "model_fact_weather",
    "model_base_gsheets_finance",
    "model_fact_beverage_consumption",
]


def timed(run, runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--all", action="store_true")
    parser.add_argument("--duckdb", action="store_true")
    parser.add_argument("--runs", type=int, default=3)
    parser.add_argument("parts", nargs="*")
    args = parser.parse_args()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.load()
    names = list(known) if args.all else HEADLINE
    names = [n for n in names if not args.parts or any(p in n for p in args.parts)]

    def compute(name: str):
        return lambda: known[name].build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        times[name] = round(timed(compute(name), args.runs), 4)
        print(f"{name} {times[name]:.3f}s", file=sys.stderr, flush=True)

    scale = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else folder,
    }
    if args.duckdb:
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET TimeZone = 'UTC'; SET threads = {cpus}")
        for table in BENCH_TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
        result["duckdb"] = {
            n: round(timed(lambda n=n: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {known[n].sql}"), args.runs), 4)
            for n in names
            if known[n].sql
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
