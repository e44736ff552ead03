"""Projections, filters and label cleaning."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import BREACH_KEYWORDS, contains_keyword, to_bool


def normalise_headers(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    drop_pattern: str | None = "^Unnamed",
    sort: bool = False,
) -> DataFrame:
    """Strip blanks from column names, rename, drop by pattern, optionally sort."""
    rename = rename or {}
    names = [rename.get(c.strip(), c.strip()) for c in df.columns]
    out = df.toDF(*names)
    kept = [c for c in names if drop_pattern is None or not re.search(drop_pattern, c)]
    return out.select(*(f"`{c}`" for c in (sorted(kept) if sort else kept)))


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def exclude_values(
    df: DataFrame, col: str, values: Iterable[str], keep_null: bool = True
) -> DataFrame:
    """Rows whose value is not listed; nulls survive unless keep_null is false."""
    return df.filter(F.coalesce(~F.col(col).isin(*values), F.lit(keep_null)))


def drop_embedded_headers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows in which a column holds its own name (a repeated CSV header)."""
    for name in columns:
        df = df.filter(F.coalesce(F.col(name) != F.lit(name), F.lit(True)))
    return df


def fill_null(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def sentinel_to_null(df: DataFrame, col: str, sentinel=-1) -> DataFrame:
    """Null instead of the sentinel, which is compared in the type of the column."""
    value = F.lit(sentinel).try_cast(df.schema[col].dataType)
    return df.withColumn(col, F.nullif(F.col(col), value))


def digits_only_rows(df: DataFrame, columns: Iterable[str], cast: str = "bigint") -> DataFrame:
    """Rows whose listed cells are digits only, as numbers; null beyond the type's range."""
    for name in columns:
        digits = F.col(name).cast("string").rlike("^[0-9]+$")
        df = df.filter(digits).withColumn(name, F.col(name).try_cast(cast))
    return df


def between_dates(df: DataFrame, col: str, first, last) -> DataFrame:
    return df.filter(F.col(col).between(F.lit(first), F.lit(last)))


def recode(
    df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None, keep: bool = False
) -> DataFrame:
    """Map values through a small dictionary; unmapped become null, or stay if keep."""
    if not mapping:
        raise ValueError("empty mapping")
    pairs = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    found = F.try_element_at(pairs, F.col(col))
    return df.withColumn(out or col, F.coalesce(found, F.col(col)) if keep else found)


def whitelist_else_other(
    df: DataFrame, col: str, values: Iterable[str], out: str, other: str = "other"
) -> DataFrame:
    return df.withColumn(out, F.when(F.col(col).isin(*values), F.col(col)).otherwise(other))


def top_n_else_other(
    df: DataFrame, col: str, n: int, out: str, other: str = "other"
) -> DataFrame:
    """Keep the n most frequent values of the data itself, ties by name."""
    top = (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), col)
        .limit(n)
        .select(F.col(col).alias("_top"))
    )
    joined = df.join(F.broadcast(top), F.col(col) == F.col("_top"), "left")
    return joined.withColumn(out, F.coalesce("_top", F.lit(other))).drop("_top")


def indicator_columns(df: DataFrame, col: str, classes: Iterable[str], prefix: str) -> DataFrame:
    """One boolean column per class."""
    return df.withColumns({f"{prefix}{c}": F.col(col).eqNullSafe(F.lit(c)) for c in classes})


def derive_by_name_pattern(df: DataFrame) -> DataFrame:
    """items = posts + comments, then excl_sub = total - in_sub, where both inputs exist."""
    names = set(df.columns)
    totals = {
        c.replace("posts", "items"): F.col(c) + F.col(c.replace("posts", "comments"))
        for c in df.columns
        if "posts" in c and c.replace("posts", "comments") in names
    }
    df = df.withColumns(totals) if totals else df
    names = set(df.columns)
    rest = {
        c.replace("_in_sub", "_excl_sub"): F.col(c.replace("_in_sub", "")) - F.col(c)
        for c in df.columns
        if "_in_sub" in c and c.replace("_in_sub", "") in names
    }
    return df.withColumns(rest) if rest else df


def map_cells(
    df: DataFrame, fn: Callable[[Column], Column], columns: Iterable[str] | None = None
) -> DataFrame:
    """Apply one Column function to every (listed) cell."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(*(fn(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns))


def keyword_filter(
    df: DataFrame, col: str, words: Iterable[str] = BREACH_KEYWORDS
) -> DataFrame:
    return df.filter(contains_keyword(F.col(col), words))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def assert_schema_subset(part: DataFrame, whole: DataFrame) -> None:
    missing = sorted(set(part.columns) - set(whole.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def select_disagree(df: DataFrame, a: str, b: str, mode: str = "lenient") -> DataFrame:
    """Normalise two label columns and keep the rows in which they differ."""
    df = df.withColumns({a: to_bool(F.col(a), mode), b: to_bool(F.col(b), mode)})
    return df.filter(~F.col(a).eqNullSafe(F.col(b)))
