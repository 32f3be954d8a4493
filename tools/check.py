"""Compare registered queries with their SQL in DuckDB.

    python tools/check.py [--sf 0.01] [--data /root/testdata] [name part ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.layouts import BENCH_TABLES  # noqa: E402
from tidemark.sources.readers import Tables  # noqa: E402

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(18,3)": "DECIMAL(18,3)",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BENCH_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> tuple[str, int]:
    got_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in described}
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    problems = []
    if set(got_types) != set(want_types):
        problems.append(f"columns {sorted(set(got_types) ^ set(want_types))}")
        return "; ".join(problems), ours.num_rows
    for name, kind in got_types.items():
        if SAME_TYPE.get(kind, kind) != want_types[name]:
            problems.append(f"type {name}: {kind} / {want_types[name]}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows {ours.num_rows} / {theirs.num_rows}")
    columns = sorted(got_types)
    a = sorted(map(repr, zip(*[ours.column(c).to_pylist() for c in columns])))
    b = sorted(map(repr, zip(*[theirs.column(c).to_pylist() for c in columns])))
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        problems.append(f"{len(left)} rows differ, e.g. {sorted(left)[:2]} / {sorted(right)[:2]}")
    return "; ".join(problems), ours.num_rows


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--data", default="/root/testdata")
    parser.add_argument("--shuffle-joins", action="store_true", help="never broadcast by size, and split the input")
    parser.add_argument("parts", nargs="*")
    args = parser.parse_args()
    folder = os.path.join(args.data, f"sf{args.sf}")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    if args.shuffle_joins:
        # Keys above a sixty-fourth of the rows count as hot, and scans give many partitions.
        conf |= {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.files.maxPartitionBytes": "64k",
            "spark.sql.files.openCostInBytes": "0",
        }
    spark = build_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), []
    for name, q in catalog.load().items():
        if args.parts and not any(p in name for p in args.parts):
            continue
        start = time.time()
        try:
            df = q.build(Tables(spark, folder))
            if q.sql is None:
                problem, rows = "", df.count()
                kind = "rows"
            else:
                problem, rows = compare(df, con, q.sql)
                kind = "sql "
        except Exception as e:  # noqa: BLE001
            problem, rows, kind = f"{type(e).__name__}: {str(e)[:1500]}", -1, "err "
        print(f"{'BAD' if problem else 'ok ':3} {kind} {name:34} {rows:9} rows {time.time() - start:6.2f}s {problem[:1800]}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
