"""Binning and small-category rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslens.operators.quantiles import exact_percentiles

# Employee-count edges and their labels.
EMPLOYEE_EDGES = [1, 500, 5000, 50000, 200000, float("inf")]
EMPLOYEE_LABELS = ["1-500", "501-5000", "5001-50000", "50001-200000", "200000+"]


def bin_fixed(x: Column, width: int, origin=0) -> Column:
    """Label 'start-end' of the half-open bin [start, start + width)."""
    start = (F.floor((x - origin) / width) * width + origin).cast("bigint")
    return F.concat(
        start.cast("string"), F.lit("-"), (start + F.lit(width - 1)).cast("string")
    )


def bin_edges(x: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the half-open bin [edge, next edge); outside all bins null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    out = F.when(F.lit(False), F.lit(labels[0]))
    for low, high, label in zip(edges, edges[1:], labels):
        test = x >= F.lit(low)
        if high != float("inf"):
            test = test & (x < F.lit(high))
        out = out.when(test, label)
    return out


def count_bins(
    df: DataFrame, col: str, edges: list[float], labels: list[str], out: str = "count"
) -> DataFrame:
    """Rows per bin in bin order, empty bins kept."""
    label = bin_edges(F.col(col), edges, labels)
    counted = df.agg(*(F.count_if(label == v).alias(f"_b{i}") for i, v in enumerate(labels)))
    cells = F.array(
        *(
            F.struct(
                F.lit(i).alias("bin_order"), F.lit(v).alias("bin"), F.col(f"_b{i}").alias(out)
            )
            for i, v in enumerate(labels)
        )
    )
    return counted.select(F.inline(cells))


def bin_quantile(
    df: DataFrame,
    col: str,
    labels: tuple[str, ...] = ("small", "medium", "large"),
    out: str = "bin",
) -> DataFrame:
    """Equal-probability bins (low, high] at exact percentiles; ties share a bin."""
    n = len(labels)
    cuts = exact_percentiles(df, [], col, {f"_c{i}": i / n for i in range(1, n)})
    # The cut points are one row, read as scalar subqueries.
    bounds = [cuts.select(f"_c{i}").scalar() for i in range(1, n)]
    label = F.when(F.col(col).isNull(), F.lit(None).cast("string"))
    for bound, name in zip(bounds, labels):
        label = label.when(F.col(col) <= bound, name)
    return df.withColumn(out, label.otherwise(labels[-1]))


def rollup_small_to_other(
    shares: DataFrame,
    key: str,
    by: str,
    threshold: float = 0.1,
    other: str = "Other",
) -> DataFrame:
    """Sum the categories whose `by` column lies below the threshold into one row."""
    name = F.when(F.col(by) < threshold, F.lit(other)).otherwise(F.col(key))
    numbers = [c for c in shares.columns if c != key]
    return (
        shares.withColumn(key, name)
        .groupBy(key)
        .agg(*(F.sum(c).alias(c) for c in numbers))
    )


def histogram_density(
    df: DataFrame, col: str, bins: int = 50, low: float = 0.0, high: float = 1e9
) -> DataFrame:
    """Density per equal-width bin of [low, high]; the last bin is closed, empty bins kept."""
    width = (high - low) / bins
    x = F.col(col).cast("double")
    index = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.filter(x.between(low, high)).groupBy(index.alias("bin")).agg(F.count("*").alias("count"))
    )
    total = counts.agg(F.sum("count")).scalar()
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = grid.join(counts, "bin", "left").na.fill(0, subset=["count"])
    return filled.select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_start"),
        "count",
        (F.col("count") / (total * width)).alias("density"),
    )
