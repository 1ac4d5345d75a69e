"""Run every registered query beside its SQL twin: ``python -m checks.compare [sf_dir] [names]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import QUERIES
from checks.twins import TWINS


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query and its twin: columns, row count, or values as a multiset."""
    relation = con.sql(sql)
    names, wanted = sorted(df.columns), sorted(relation.columns)
    if names != wanted:
        return [f"columns {names} instead of {wanted}"]
    ours = sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))
    at = [relation.columns.index(n) for n in names]
    theirs = sorted(map(repr, (tuple(r[i] for i in at) for r in relation.fetchall())))
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows instead of {len(theirs)}"]
    return [f"{a}\n      instead of {b}" for a, b in zip(ours, theirs) if a != b][:3]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.environ.get("TMPDIR", "/tmp") + "/tablelift-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, bad = session(), connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            found = differences(QUERIES[name](spark, sf_dir), con, TWINS[name])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.monotonic() - started:.2f}s", flush=True)
        for line in found:
            print(f"    {line}")
    print(f"{bad} of {len(names or QUERIES)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
