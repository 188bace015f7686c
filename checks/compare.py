"""Run the registered queries against their oracle SQL, as the correctness check does.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def local_session(cpus: int | str = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartlake-checks")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(value):
    if value is None or isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_kind(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its oracle; empty if they agree."""
    df = QUERIES[name](spark, sf_dir)
    mine = df.collect()
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    if len(mine) != len(theirs):
        out.append(f"{len(mine)} rows against {len(theirs)}")
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        out.append(f"values: {only_a} against {only_b}")
    return out


def main() -> int:
    sf_dir, *wanted = sys.argv[1:]
    spark, con = local_session(os.environ.get("BENCH_CPUS", 8)), oracle(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            diff = differences(spark, con, name, sf_dir) if name in ORACLES else ["no oracle"]
        except Exception as error:
            diff = [f"{type(error).__name__}: {str(error)[:600]}"]
        wrong += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - start:.1f}s {'; '.join(diff)}", flush=True)
    print(f"{wrong} of {len(wanted or QUERIES)} queries differ")
    return wrong


if __name__ == "__main__":
    sys.exit(bool(main()))
