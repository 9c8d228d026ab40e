"""Compare registered queries with their SQL on DuckDB: ``python check.py [sf] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

from vanecast.catalog import ORACLES, QUERIES
from vanecast.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (repr(v) if v or math.copysign(1, v) > 0 else "-0.0")
    return None if v is None else str(v) if not isinstance(v, bool) else str(v)


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return f"rows only ({len(got[1])})" if got[1] else "EMPTY"
    cur = con.execute(ORACLES[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"ROWS {len(got[1])} {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"VALUES {len(bad)} of {len(want[1])}: {bad[0]}"
    return f"ok ({len(want[1])})"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = [n for n in QUERIES if not argv[1:] or any(n.startswith(a) for a in argv[1:])]
    # SPLIT=1 makes every group "hot" and every lookup "large", so the paths for big data run
    small = {
        "spark.vanecast.groupRows": "150",
        "spark.vanecast.broadcastRows": "5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    spark = build_session(
        "check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
        **(small if os.environ.get("SPLIT") else {}),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as error:  # report every query
            result = "ERROR " + str(error).split("JVM stacktrace")[0][:700]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        good = result.startswith(("ok", "rows only"))
        failed += not good
        print(f"{'  ' if good else '!!'} {name:28s} {time.time() - start:6.2f}s {result}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
