"""Runs registered queries against their SQL in DuckDB and compares the rows.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "timestamp": "TIMESTAMP",
         "date": "DATE", "boolean": "BOOLEAN"}


def difference(df, con, sql: str) -> str | None:
    """What sets the query's result apart from the SQL's, or None."""
    got = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != kinds[name]:
            return f"type of {name}: {dtype} vs {kinds[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} vs {w}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                found = difference(df, con, sqls[name])
            else:
                found = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - reported, and counted as a failure
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sqls else '(no SQL) '}{found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
