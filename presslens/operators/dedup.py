"""Deduplication. Every "keep one" needs an order that is total within the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key. Spark limits each map task to one row per key before the
    shuffle (window group limit), so a hot key does not travel."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_earliest(
    df: DataFrame, passes: list[list[str]], date: str, tiebreak: list[str]
) -> DataFrame:
    """Earliest row per key, once for each key list; rows with a null key vanish."""
    for keys in passes:
        df = keep_first(df.na.drop(subset=[*keys, date]), keys, [date, *tiebreak])
    return df


def keep_largest(
    df: DataFrame,
    keys: list[str],
    size: str,
    tiebreak: list[str],
    fill: float | None = None,
) -> DataFrame:
    """Largest size per key. Null sizes are dropped unless filled."""
    if fill is not None:
        df = df.na.fill({size: fill})
    return keep_first(df.na.drop(subset=[*keys, size]), keys, [F.desc(size), *tiebreak])


def members_of_duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    repeated = (
        df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    )
    return df.join(repeated, keys, "left_semi")
