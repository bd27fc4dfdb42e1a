"""Runs registered queries beside their SQL in DuckDB and compares schema names, row counts and values.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:10]
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want_cols, want = _rows(list(kinds), cursor.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if names.get(kinds[c], kinds[c]) != t]
    return f"types {odd}" if odd else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, only = argv[0], argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in oracles or (only and name not in only):
            continue
        start = time.time()
        problem = compare(spark, con, sf_dir, name, query, oracles[name])
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
