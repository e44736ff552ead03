"""Bootstrap percentile intervals that never build a resampled table.

A resample is described by how often each row is drawn. Drawing n*frac rows with
replacement makes these counts Poisson(frac) for large n, and a hash of row key and
replicate number decides them, so results do not depend on partitioning.

Any statistic that is a function of sums can be resampled: name the sums (`moments`), and give the
statistics as columns over them. Replicates of the sums are added up in the tasks, and the
statistics are worked out once per replicate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

_CHUNK = 2048
_MAX_OPEN_GROUPS = 256


def _mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of the public-domain splitmix64 generator."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _uniform(keys: np.ndarray, replicates: int) -> np.ndarray:
    """Matrix (rows, replicates) of uniforms in [0, 1) from 64-bit keys."""
    steps = np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = _mix(keys.astype(np.uint64)[:, None] + steps[None, :])
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _poisson_steps(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities far enough for doubles."""
    k = np.arange(int(mean + 12 * np.sqrt(mean) + 30))
    logs = k * np.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(logs))


def row_key(key: list[str], seed: int) -> Column:
    """60 bits of an MD5 over the key columns and the seed, null parts left out."""
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in key), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def bootstrap_totals(
    df: DataFrame,
    key: list[str],
    values: list[str],
    groups: list[str] | None = None,
    n: int = 1000,
    frac: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """(groups, replicate, value totals) of weighted sums over resamples.

    Each task adds weights-times-values into one matrix per group and emits one row per
    group and replicate; a sum finishes the job.
    """
    groups = groups or []
    steps = _poisson_steps(frac)
    rows = df.select(
        *groups,
        row_key(key, seed).alias("_key"),
        *(F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values),
    )

    integral = {f.name for f in rows.schema if isinstance(f.dataType, IntegralType)}

    def emit(sums: dict) -> Iterator[pd.DataFrame]:
        for name, matrix in sums.items():
            out = pd.DataFrame(matrix, columns=values)
            out.insert(0, "replicate", np.arange(n, dtype=np.int64))
            for column, value in zip(groups, name):
                whole = column in integral and not pd.isna(value)
                value = None if pd.isna(value) else int(value) if whole else value
                out[column] = pd.Series([value] * n, dtype=object)  # typed by the schema, also where null
            yield out[[*groups, "replicate", *values]]

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            parts = batch.groupby(groups, dropna=False) if groups else [((), batch)]
            for name, part in parts:
                name = name if isinstance(name, tuple) else (name,)
                total = sums.setdefault(name, np.zeros((n, len(values))))
                hashed = part["_key"].to_numpy().astype(np.int64).view(np.uint64)
                amounts = part[values].to_numpy(dtype=float)
                for start in range(0, len(part), _CHUNK):
                    piece = slice(start, start + _CHUNK)
                    weights = np.searchsorted(steps, _uniform(hashed[piece], n), side="right")
                    total += weights.T.astype(float) @ amounts[piece]
            if len(sums) > _MAX_OPEN_GROUPS:
                yield from emit(sums)
                sums = {}
        yield from emit(sums)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in groups]
    schema = ", ".join([*fields, "replicate bigint", *(f"`{v}` double" for v in values)])
    return (
        rows.mapInPandas(partials, schema)
        .groupBy(*groups, "replicate")
        .agg(*(F.sum(v).alias(v) for v in values))
    )


def percentile_interval(
    replicates: DataFrame, stat: str, groups: list[str] | None = None, alpha: float = 0.05
) -> DataFrame:
    """Percentile interval over replicates; null statistics are dropped. A group holds at
    most one row per replicate, so the exact built-in is safe."""
    ends = F.percentile(stat, [alpha / 2, 1 - alpha / 2])
    rows = replicates.filter(F.col(stat).isNotNull()).groupBy(*(groups or []))
    out = rows.agg(ends.alias("_ends"), F.count("*").alias("n_replicates"))
    return out.select(
        *(groups or []),
        F.col("_ends")[0].alias("low"),
        F.col("_ends")[1].alias("high"),
        "n_replicates",
    )


def bootstrap_statistics_ci(
    df: DataFrame,
    key: list[str],
    moments: dict[str, Column],
    stats: dict[str, Column],
    groups: list[str] | None = None,
    n: int = 1000,
    frac: float = 1.0,
    alpha: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """(groups, statistic, low, high, n_replicates): intervals of several statistics at once.

    `moments` are columns that are summed over a resample (a null adds nothing), `stats` columns
    over these sums. A replicate in which a statistic is null, such as a ratio with the
    denominator 0, is left out for that statistic; with none left it has no row.
    """
    groups = groups or []
    rows = df.select(*groups, *(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), *(c.alias(m) for m, c in moments.items()))
    keys = [f"_k{i}" for i in range(len(key))]
    totals = bootstrap_totals(rows, keys, list(moments), groups, n, frac, seed)
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("statistic"), c.cast("double").alias("_stat")) for s, c in stats.items())))
    values = totals.select(*groups, each.alias("_s")).select(*groups, "_s.statistic", "_s._stat")
    return percentile_interval(values, "_stat", [*groups, "statistic"], alpha)


def regression_moments(x: Column, y: Column, x0: float = 0.0, y0: float = 0.0) -> dict[str, Column]:
    """Sums for a line and a correlation over rows with both values, measured from (x0, y0)."""
    both = x.isNotNull() & y.isNotNull()
    u, v = x.cast("double") - x0, y.cast("double") - y0
    sums = {"n": F.lit(1.0), "sx": u, "sy": v, "sxx": u * u, "sxy": u * v, "syy": v * v}
    return {name: F.when(both, c) for name, c in sums.items()}


def _spread(a: str, b: str, product: str) -> Column:
    return F.col("n") * F.col(product) - F.col(a) * F.col(b)


def slope() -> Column:
    return F.try_divide(_spread("sx", "sy", "sxy"), _spread("sx", "sx", "sxx"))


def line_at(x: float, x0: float = 0.0, y0: float = 0.0) -> Column:
    """Height of the fitted line at x, with the origin that the moments were measured from."""
    middle = F.try_divide(F.col("sx"), F.col("n"))
    return F.lit(y0) + F.try_divide(F.col("sy"), F.col("n")) + slope() * (F.lit(x - x0) - middle)


def correlation() -> Column:
    scale = F.sqrt(F.greatest(_spread("sx", "sx", "sxx"), F.lit(0.0)) * F.greatest(_spread("sy", "sy", "syy"), F.lit(0.0)))
    return F.try_divide(_spread("sx", "sy", "sxy"), scale)


def confusion_moments(truth: Column, predicted: Column) -> dict[str, Column]:
    """Counts of a yes/no classifier; rows without truth or prediction count nowhere."""
    cells = {"tp": truth & predicted, "fp": ~truth & predicted, "fn": truth & ~predicted, "tn": ~truth & ~predicted}
    return {name: F.when(c, 1.0) for name, c in cells.items()}


def precision() -> Column:
    return F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))


def f1() -> Column:
    return F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def resampled_band(
    df: DataFrame, key: list[str], x: str, y: str, grid: list[float], n: int = 1000,
    frac: float = 1.0, alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """(grid, low, high, n_replicates): band of a regression line from resampled fits."""
    # Measured from the means, so that far-off values do not cancel.
    means = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(F.avg(x).alias("x"), F.avg(y).alias("y")).first()
    x0, y0 = (float(m) if m is not None else 0.0 for m in means)
    stats = {repr(float(g)): line_at(float(g), x0, y0) for g in grid}
    moments = regression_moments(F.col(x), F.col(y), x0, y0)
    band = bootstrap_statistics_ci(df, key, moments, stats, None, n, frac, alpha, seed)
    return band.select(F.col("statistic").cast("double").alias("grid"), "low", "high", "n_replicates")


def bootstrap_mean_ci(
    df: DataFrame,
    key: list[str],
    value: str,
    groups: list[str] | None = None,
    n: int = 1000,
    frac: float = 0.2,
    alpha: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Interval of a mean (or any ratio of two additive columns through bootstrap_totals)."""
    rows = df.filter(F.col(value).isNotNull()).withColumn("_one", F.lit(1.0))
    totals = bootstrap_totals(rows, key, [value, "_one"], groups, n, frac, seed)
    totals = totals.withColumn("_stat", F.try_divide(F.col(value), F.col("_one")))
    return percentile_interval(totals, "_stat", groups, alpha)


def bootstrap_share_ci(
    df: DataFrame,
    col: str,
    n: int = 1000,
    frac: float = 1.0,
    alpha: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Interval of each category's share of the non-null rows.

    Works on the category counts: the number of draws of a category of size c is
    Poisson(c*frac), normalised by the replicate total. A category absent from a replicate
    is skipped there, not counted as 0.
    """
    counts = (
        df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
    ).withColumn("_key", F.xxhash64(F.col(col), F.lit(seed)))

    def redraw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, size, key in zip(batch[col], batch["_n"], batch["_key"]):
                generator = np.random.default_rng(np.uint64(np.int64(key).view(np.uint64)))
                draws = generator.poisson(size * frac, n)
                yield pd.DataFrame(
                    {col: name, "replicate": np.arange(n, dtype=np.int64), "draws": draws}
                )

    kind = df.schema[col].dataType.simpleString()
    drawn = counts.mapInPandas(redraw, f"`{col}` {kind}, replicate bigint, draws bigint")
    drawn = drawn.filter("draws > 0")
    totals = drawn.groupBy("replicate").agg(F.sum("draws").alias("_total"))
    shares = drawn.join(totals, "replicate").withColumn(
        "share", F.col("draws") / F.col("_total")
    )
    return percentile_interval(shares, "share", [col], alpha)
