"""Run a registered query and its SQL on the same tables and compare them.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(df, connection, sql) -> str | None:
    """What differs between a Spark result and the SQL result; None if nothing does."""
    cursor = connection.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    ours_types = {
        f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
        for f in df.schema.fields
    }
    if ours_types != theirs_types:
        return f"types {ours_types} vs {theirs_types}"
    ours = [tuple(r) for r in df.collect()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    left, right = rows_of(df.columns, ours), rows_of(list(theirs_types), theirs)
    for a, b in zip(left, right):
        if a != b:
            return f"{a} vs {b}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            df = function(spark, folder)
            if sql is None:
                result = f"rows only: {df.count()}"
            else:
                result = differences(df, connection, sql)
                bad += result is not None
                result = result or f"ok {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            bad += 1
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - started:6.1f}s {result}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
