"""Whole rows: hashes over columns of any type, names that no column has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, StructType) or all(_hashable(f.dataType) for f in kind.fields)


def row_hash(docs: DataFrame, *first: Column) -> Column:
    """xxhash64 of `first` and all columns; maps and variants, which have no hash, as JSON."""
    parts = [
        column(f.name) if _hashable(f.dataType) else F.to_json(F.struct(column(f.name)))
        for f in docs.schema.fields
    ]
    return F.xxhash64(*first, *parts)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of docs needs it."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
        taken.add(name.lower())
    return found
