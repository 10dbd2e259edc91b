"""Compare registered queries with their DuckDB texts on one data folder."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, Decimal):
        return f"d{value.normalize():f}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value:.9e}"
    if isinstance(value, int):
        return f"i{value}"
    return f"{type(value).__name__}:{value}"


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, key: str, build, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    df = build(spark, folder)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows, no oracle, {spent:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        left, right = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return False, f"rows {len(a)} vs {len(b)}; spark only {left}; duckdb only {right}"
    return True, f"{len(a)} rows, {spent:.1f}s"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), entry.oracle_sql(), 0
    for key, build in entry.queries().items():
        if wanted and key not in wanted:
            continue
        try:
            ok, note = compare(spark, con, folder, key, build, sqls.get(key))
        except Exception as err:  # noqa: BLE001 - report and go on with the next query
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        bad += not ok
        if not ok or "-v" in sys.argv or wanted:
            print("ok  " if ok else "BAD ", key, note, flush=True)
        elif "no oracle" in note or " 0 rows" in f" {note}":
            print("note", key, note, flush=True)
    print(f"{len(entry.queries())} queries, {bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main([a for a in sys.argv[1:] if a != "-v"]))
