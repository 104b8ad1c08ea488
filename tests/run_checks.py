"""Runs registered queries against their SQL: python tests/run_checks.py [sf dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None if rows, names and values agree, else what differs."""
    frame = contract.queries()[name](spark, sf_dir)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None
    result = con.sql(sql)
    want = canonical(result.columns, result.fetchall())
    if got == want:
        return None if got[1] else "no rows"
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    different = next((pair for pair in zip(got[1], want[1]) if pair[0] != pair[1]), None)
    return f"{len(got[1])} rows != {len(want[1])} rows; first difference {different}"


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - a failing query is reported, the others still run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    sys.exit(bool(failed))
