"""Column expressions over array<float|double> vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LAYER_NORM_EPS = 1e-5  # fixed value: default of the usual layer-norm implementation


def _sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def _bind(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body loops over an array."""
    return F.transform(F.array(value), body)[0]


def layer_norm(vector: Column, eps: float = LAYER_NORM_EPS) -> Column:
    def scaled(centred: Column) -> Column:
        variance = _sum(F.transform(centred, lambda x: x * x)) / F.size(centred)
        return _bind(F.sqrt(variance + eps), lambda s: F.transform(centred, lambda x: x / s))

    def centred(values: Column) -> Column:
        return _bind(
            _sum(values) / F.size(values),
            lambda mean: _bind(F.transform(values, lambda x: x - mean), scaled),
        )

    return _bind(vector.cast("array<double>"), centred)


def l2_normalise(vector: Column) -> Column:
    def scaled(values: Column) -> Column:
        norm = F.sqrt(_sum(F.transform(values, lambda x: x * x)))
        return _bind(
            F.greatest(norm, F.lit(1e-12)), lambda n: F.transform(values, lambda x: x / n)
        )

    return _bind(vector.cast("array<double>"), scaled)


def squared_distance(a: Column, b: Column) -> Column:
    diffs = F.zip_with(
        a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y)
    )
    return _sum(diffs)
