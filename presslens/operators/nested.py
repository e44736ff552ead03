"""Nested JSON values as keys and as records to enrich."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def canonical_json(text: Column) -> Column:
    """JSON text with sorted object fields and no layout: equal values give equal text."""
    return F.to_json(F.parse_json(text))


def group_by_nested(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Rows per nested value, whatever the order of its fields."""
    return df.groupBy(canonical_json(F.col(col)).alias("nested_key")).agg(F.count("*").alias(out))


def add_json_field(
    df: DataFrame,
    col: str,
    schema: str,
    key: str,
    field: str,
    lookup: dict[str, str],
    default: str = "others",
) -> DataFrame:
    """Enrich a JSON object with a value looked up by one of its fields."""
    parsed = F.from_json(F.col(col), schema)
    pairs = F.create_map(*(F.lit(x) for kv in lookup.items() for x in kv))
    value = F.coalesce(F.try_element_at(pairs, parsed[key].cast("string")), F.lit(default))
    return df.withColumn(col, F.to_json(parsed.withField(field, value)))
