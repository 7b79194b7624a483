"""Compare registered queries with their oracle SQL.

``python tests/oracle.py [sf_dir [name ...]]`` runs it by hand.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {c[0]: str(c[1]).upper() for c in cursor.description}
    for column, kind in df.dtypes:
        if types[column] != SAME_TYPE.get(kind):
            return f"type of {column}: {kind} != {types[column]}"
    order = [names.index(c) for c in sorted(names)]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    rows = df.select(*sorted(df.columns)).collect()
    found = Counter(tuple(row) for row in rows)
    if found == expected:
        return None
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"extra {list((found - expected).items())[:2]}, "
        f"missing {list((expected - found).items())[:2]}"
    )


def main(sf_dir: str, only: list[str]) -> None:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from pyspark.sql import SparkSession

    from tillwright.registry import all_queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = difference(query.run(spark, sf_dir), con, query.sql) if query.sql else "no SQL"
        except Exception as error:  # report it and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {result or 'ok'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
