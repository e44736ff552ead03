"""Set operations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rows_once(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur exactly once over both inputs."""
    counted = a.unionByName(b).groupBy(*a.columns).agg(F.count("*").alias("_n"))
    return counted.filter("_n = 1").drop("_n")


def intersect_keys(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), (t.select(*keys) for t in tables))


def unpivot(
    df: DataFrame, ids: list[str], values: list[str], variable: str, value: str
) -> DataFrame:
    """Wide value columns to (variable, value) rows."""
    return df.unpivot(ids, values, variable, value)
