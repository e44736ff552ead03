"""Run registered queries beside their SQL in DuckDB and compare all values.

    python -m tests.compare [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import tempfile
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: int | str = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("presslens")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="presslens-"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def kind(type_name: str) -> str:
    name = type_name.lower()
    for family, words in {
        "int": ("bigint", "long"), "int32": ("int", "integer"), "float": ("double", "float"),
        "text": ("varchar", "string"), "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in words:
            return family
    return name


def compare(spark, folder: str, name: str, query, sql: str | None) -> dict:
    import duckdb

    started = time.perf_counter()
    df = query(spark, folder)
    rows = df.collect()
    result = {"name": name, "rows": len(rows), "seconds": round(time.perf_counter() - started, 2)}
    columns = sorted(df.columns)
    if sql is None:
        return result | {"status": "rows-only"}
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(names) != columns:
        return result | {"status": f"COLUMNS {columns} != {sorted(names)}"}
    expected = Counter(
        tuple(canonical(r[names.index(c)]) for c in columns) for r in expected_rows
    )
    actual = Counter(tuple(canonical(r[c]) for c in columns) for r in rows)
    if expected != actual:
        missing, extra = list((expected - actual).items())[:3], list((actual - expected).items())[:3]
        return result | {
            "status": f"VALUES {len(expected_rows)} expected; missing {missing}; extra {extra}"
        }
    described = {r[0]: kind(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {
        c: (described[c], kind(df.schema[c].dataType.simpleString()))
        for c in columns
        if described[c] != kind(df.schema[c].dataType.simpleString())
    }
    return result | {"status": "ok", "types": types or ""}


def main() -> None:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = session()
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            result = compare(spark, folder, name, query, oracles.get(name))
        except Exception as error:  # report and go on with the next query
            result = {"name": name, "status": f"ERROR {type(error).__name__}: {str(error)[:600]}"}
        good = result["status"] in ("ok", "rows-only")
        bad += not good
        print(name, result, flush=True)
    print(f"{bad} bad", flush=True)


if __name__ == "__main__":
    main()
