"""Run registered queries next to their SQL and compare the rows.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty if nothing does."""
    result = con.execute(sql)
    expected_columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return [f"columns {sorted(df.columns)} but SQL gives {sorted(expected_columns)}"]
    expected = _bag(expected_columns, result.fetchall())
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    found = []
    for label, rows in (("only in Spark", got - expected), ("only in SQL", expected - got)):
        if rows:
            found.append(f"{sum(rows.values())} rows {label}, such as {next(iter(rows))}")
    return found if got.total() else [*found, "no rows"]


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(args.sf), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in (args.names or sqls) or name not in sqls:
            continue
        start = time.time()
        try:
            df = query(spark, args.sf)
            found = differences(df, con, sqls[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found,
              sep="\n     ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
