"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name …]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from firmweave.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _value(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 9)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return f"rows={got.total()}"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(columns)} != {sorted(df.columns)}"
    if got == want:
        return f"ok rows={got.total()}"
    return f"DIFF got={got.total()} want={want.total()} extra={list((got - want))[:2]} missing={list((want - got))[:2]}"


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in names:
        begin = time.time()
        try:
            result = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:40s} {time.time() - begin:6.2f}s {result[:1500]}", flush=True)


if __name__ == "__main__":
    main()
