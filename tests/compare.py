"""Run queries and their SQL twins side by side and compare rows, order aside.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    have = _rows(frame.columns, frame.collect())
    if want == have:
        return None
    missing, extra = list((want - have).items())[:3], list((have - want).items())[:3]
    return f"{sum(have.values())} rows, want {sum(want.values())}; missing {missing}; extra {extra}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        begin = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sql:
                problem = compare(frame, connection, sql[name])
                verdict = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                verdict = f"rows {frame.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += verdict[:2] not in ("ok", "ro")
        print(f"{time.time() - begin:6.2f}s {name}: {verdict}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
