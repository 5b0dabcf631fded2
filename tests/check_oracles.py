"""Run every query next to its SQL and compare columns, types and rows, whatever their order.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type of the same values.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    return value


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, spark_type in df.dtypes:
        if SAME_TYPE.get(spark_type) != types[name]:
            return f"type of {name}: {spark_type} != {types[name]}"
    order = [names.index(c) for c in df.columns]
    expected = Counter(
        tuple(_plain(row[i]) for i in order) for row in con.execute(sql).fetchall()
    )
    actual = Counter(tuple(_plain(v) for v in row) for row in df.collect())
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return (
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"extra {list(extra.items())[:2]}; missing {list(missing.items())[:2]}"
        )
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from stationflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "check",
        "local[8]",
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                verdict = "same" if problem is None else f"DIFFERS: {problem}"
            else:
                problem, verdict = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - started:6.1f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
