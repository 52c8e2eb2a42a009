"""Run every query against its DuckDB counterpart: ``python -m checks.compare [dir] [name…]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracles
from checks.queries import registered

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows(names: list[str], data) -> list[tuple]:
    """Rows with columns in name order, sorted; ``repr`` keeps every bit of a double."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in data)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> list[str]:
    df = registered()[name](spark, sf_dir)
    result = con.execute(oracles()[name])
    expected_names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(expected_names):
        return [f"columns {sorted(df.columns)} != {sorted(expected_names)}"]
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    expected = rows(expected_names, result.fetchall())
    if got == expected:
        return []
    out = [f"{len(got)} rows, expected {len(expected)}"]
    extra, missing = set(got) - set(expected), set(expected) - set(got)
    out += [f"  extra   {r}"[:600] for r in sorted(extra)[:2]]
    out += [f"  missing {r}"[:600] for r in sorted(missing)[:2]]
    return out


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    wrong = 0
    for name in args[1:] or registered():
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            found = [str(error)[:1500]]
        wrong += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n  ")
    print(f"{wrong} wrong")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
