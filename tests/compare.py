"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from veilspark.session import build_session
from workload import QUERIES, SQL

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted_columns(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values have to agree in type as well."""
    got_names, got = _sorted_columns(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    want_names, want = _sorted_columns([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        only_got, only_want = list((got - want).items())[:2], list((want - got).items())[:2]
        sizes = f"{sum(got.values())} rows, expected {sum(want.values())}"
        return f"{sizes}; only in Spark {only_got}; only in SQL {only_want}"
    kinds = lambda rows: [{type(v) for v in column if v is not None} for column in zip(*rows)]
    if kinds(got) != kinds(want):
        return "value types differ"
    return None if got else "no rows"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        started = time.perf_counter()
        try:
            found = difference(QUERIES[name](spark, args.sf), con, SQL[name])
        except Exception as error:  # report every query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok':4} {time.perf_counter() - started:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
