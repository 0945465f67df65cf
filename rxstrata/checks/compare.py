"""Run registered queries next to their SQL oracles and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from rxstrata.checks.oracle import ORACLES
from rxstrata.checks.queries import QUERIES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(got: DataFrame, connection, name: str) -> list[str]:
    """What differs between a query's result and its oracle, a few rows of each side."""
    want = connection.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    order = sorted(columns)
    if sorted(got.columns) != order:
        return [f"columns {sorted(got.columns)} against {order}"]
    places = [columns.index(c) for c in order]
    expected = Counter(tuple(row[i] for i in places) for row in want.fetchall())
    actual = Counter(tuple(row) for row in got.select(*[f"`{c}`" for c in order]).collect())
    extra, missing = actual - expected, expected - actual
    if not extra and not missing:
        return []
    found = [f"{sum(extra.values())} rows only here, {sum(missing.values())} only in the oracle"]
    found += [f"here   {row}" for row in list(extra)[:3]]
    found += [f"oracle {row}" for row in list(missing)[:3]]
    return [str(order), *found]


def main(folder: str, names: list[str]) -> int:
    from rxstrata.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = oracle_connection(folder), 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            if name in ORACLES:
                found = differences(QUERIES[name](spark, folder), connection, name)
            else:
                found = [] if QUERIES[name](spark, folder).count() else ["no rows"]
        except Exception as error:  # report every query, whatever one of them does
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("    ", line)
    print(f"{failed} failed; without oracle: {sorted(set(QUERIES) - set(ORACLES))}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
