"""Compare registered queries with their SQL: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract
    from tidewatch.session import build_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    all_queries, sqls = contract.queries(), contract.oracle_sql()
    names = argv[1:] or list(all_queries)
    bad = 0
    for name in names:
        started = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, all_queries[name], sqls[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"rows {len(all_queries[name](spark, sf_dir).collect())}"
        except Exception as error:  # report and go on
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:40s} {time.time() - started:6.2f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad; without SQL: {sorted(set(all_queries) - set(sqls))}")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
