"""Counts, shares, cross tables and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslens.operators.joins import outer_fill
from presslens.operators.quantiles import exact_percentiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def count_by(df: DataFrame, keys: list[str], out: str = "count", dropna: bool = True) -> DataFrame:
    """Rows per key; groups with a null key are left out by default."""
    if dropna:
        df = df.na.drop(subset=keys)
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def share_of_total(counts: DataFrame, count: str, out: str = "percentage") -> DataFrame:
    """count / sum(count) * 100, null where the counts add up to nothing.

    The total is a scalar subquery, not a one-task window.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(out, F.try_divide(F.col(count), total) * 100)


def compare_shares(
    df: DataFrame, key: str, populations: dict[str, Column], dropna: bool = True
) -> DataFrame:
    """Counts and percentages of several populations of one table, in one scan.

    A population is a boolean condition; empty cells are 0.
    """
    if dropna:
        df = df.na.drop(subset=[key])
    counts = df.groupBy(key).agg(
        *(F.count(F.when(cond, 1)).alias(f"count_{name}") for name, cond in populations.items())
    )
    counts = counts.filter(" + ".join(f"count_{name}" for name in populations) + " > 0")
    for name in populations:
        counts = share_of_total(counts, f"count_{name}", f"percentage_{name}")
    return counts


def compare_share_tables(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """compare_shares over separate tables: one count per table, then an outer join."""
    counted = [
        share_of_total(count_by(df, [key], f"count_{name}"), f"count_{name}", f"percentage_{name}")
        for name, df in tables.items()
    ]
    return outer_fill(counted, key)


def share_difference_top(
    shares: DataFrame, key: str, a: str, b: str, n: int = 15, signed: bool = False
) -> DataFrame:
    """The n keys with the largest difference between two percentages."""
    diff = F.col(a) - F.col(b)
    shares = shares.withColumn("difference", diff if signed else F.abs(diff))
    return shares.orderBy(F.desc("difference"), key).limit(n)


def first_by(col: str, order: str) -> Column:
    """First non-null value in the given order."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def event_summary(
    df: DataFrame,
    event: list[str],
    attributes: list[str],
    order: str,
    headline: str,
    publication: str,
) -> DataFrame:
    """Per event: first non-null attributes, article count, distinct headlines and publications.

    Distinct counts run in an aggregate of their own: beside them Spark would expand and
    re-shuffle every row once per distinct column, attributes included.
    """
    df = df.na.drop(subset=event)
    firsts = df.groupBy(*event).agg(
        *(first_by(c, order).alias(c) for c in attributes), F.count(headline).alias("n_articles")
    )
    distinct = df.groupBy(*event).agg(
        F.count_distinct(F.col(headline)).alias("n_headlines"),
        F.count_distinct(F.col(publication)).alias("n_publications"),
    )
    return firsts.join(distinct, event)


def crosstab_with_total(
    df: DataFrame, row: str, col: str, levels: list[str], total: str = "Total"
) -> DataFrame:
    """Counts per row value and level, empty cells 0, with a row total."""
    wide = df.na.drop(subset=[row, col]).groupBy(row).pivot(col, levels).count()
    wide = wide.na.fill(0, subset=levels)
    return wide.withColumn(total, sum((F.col(f"`{v}`") for v in levels), F.lit(0)))


def conditional_sums(
    df: DataFrame, keys: list[str], conditions: dict[str, Column], total: str
) -> DataFrame:
    """Row count and one conditional count per class."""
    return df.groupBy(*keys).agg(
        F.count("*").alias(total), *(F.count_if(c).alias(name) for name, c in conditions.items())
    )


def avg_per_event(df: DataFrame, group: str, count: str, event: str) -> DataFrame:
    """Mentions per event for each group; null for a group without events."""
    out = df.na.drop(subset=[group]).groupBy(group).agg(
        F.sum(count).alias("total_articles"), F.count_distinct(F.col(event)).alias("n_events")
    )
    return out.withColumn("articles_per_event", F.try_divide("total_articles", "n_events"))


def lifetime(df: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last))


def two_level_totals(
    df: DataFrame, outer: str, inner: str, value: str, out_value: str, out_count: str
) -> DataFrame:
    """Reduce to (outer, inner) first, so a value is added once per inner entity."""
    per_pair = df.na.drop(subset=[outer, inner]).groupBy(outer, inner).agg(
        F.max(value).alias("_value"), F.count("*").alias("_n")
    )
    return per_pair.groupBy(outer).agg(
        F.sum("_value").alias(out_value), F.sum("_n").alias(out_count)
    )


def totals_raw_vs_distinct(
    df: DataFrame, group: str, entity: str, value: str, out_count: str, out_value: str
) -> DataFrame:
    """Rows per group over all rows, value per group over distinct entities."""
    per_entity = df.na.drop(subset=[group]).groupBy(group, entity).agg(
        F.count("*").alias("_n"), F.max(value).alias("_value")
    )
    # A null entity still counts as rows, but carries no value.
    return per_entity.groupBy(group).agg(
        F.sum("_n").alias(out_count),
        F.coalesce(F.sum(F.when(F.col(entity).isNotNull(), F.col("_value"))), F.lit(0)).alias(
            out_value
        ),
    )


def dense_crosstab(
    df: DataFrame, row: str, col: str, levels: list, out: str = "count"
) -> DataFrame:
    """Long table of every row value and every level, missing cells 0."""
    flat = df.na.drop(subset=[row]).groupBy(row).agg(
        *(F.count(F.when(F.col(col) == F.lit(v), 1)).alias(f"_l{i}") for i, v in enumerate(levels))
    )
    cells = F.array(
        *(
            F.struct(F.lit(v).alias(col), F.col(f"_l{i}").alias(out))
            for i, v in enumerate(levels)
        )
    )
    return flat.select(row, F.inline(cells))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    long = df.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                    for c in columns
                )
            )
        )
    )
    basic = long.groupBy("column").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    return basic.join(exact_percentiles(long, ["column"], "x", QUARTILES), "column", "left")


def counts_for_categories(
    tables: dict[str, DataFrame], col: str, categories: list[str]
) -> DataFrame:
    """Count of each listed category in each table, zero-filled."""
    rows = []
    for source, df in tables.items():
        counted = df.agg(
            *(F.count_if(F.col(col) == F.lit(c)).alias(f"_c{i}") for i, c in enumerate(categories))
        )
        cells = F.array(
            *(
                F.struct(F.lit(c).alias("category"), F.col(f"_c{i}").alias("count"))
                for i, c in enumerate(categories)
            )
        )
        rows.append(counted.select(F.lit(source).alias("source"), F.inline(cells)))
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


def iqr_bounds(df: DataFrame, group: str, x: str, factor: float = 1.5) -> DataFrame:
    """Exact quartiles per group and the fences beyond which a value is an outlier."""
    quartiles = exact_percentiles(df, [group], x, QUARTILES)
    iqr = F.col("q75") - F.col("q25")
    return quartiles.withColumns(
        {"low_fence": F.col("q25") - factor * iqr, "high_fence": F.col("q75") + factor * iqr}
    )


def iqr_outliers(df: DataFrame, group: str, x: str, factor: float = 1.5) -> DataFrame:
    """Rows outside the fences of their group."""
    joined = df.join(iqr_bounds(df, group, x, factor), group)
    return joined.filter((F.col(x) < F.col("low_fence")) | (F.col(x) > F.col("high_fence")))


def box_numbers(df: DataFrame, group: str, x: str) -> DataFrame:
    """Five box-plot numbers per group: quartiles and whiskers (extreme inliers)."""
    bounds = iqr_bounds(df, group, x)
    inside = F.col(x).between(F.col("low_fence"), F.col("high_fence"))
    whiskers = (
        df.join(bounds, group)
        .groupBy(group)
        .agg(
            F.min(F.when(inside, F.col(x))).alias("whisker_low"),
            F.max(F.when(inside, F.col(x))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
    return bounds.select(group, "q25", "q50", "q75").join(whiskers, group)


def group_order_by_stat(df: DataFrame, group: str, x: str, stat: str = "median") -> DataFrame:
    """Groups ordered by their median or maximum, largest first."""
    if stat == "median":
        out = exact_percentiles(df, [group], x, {"stat": 0.5})
    elif stat == "max":
        out = df.na.drop(subset=[group]).groupBy(group).agg(F.max(x).alias("stat"))
    else:
        raise ValueError(f"unknown statistic {stat!r}")
    return out.orderBy(F.desc("stat"), group)


def distinct_counts(
    df: DataFrame, keys: list[str], columns: list[str], approximate: bool = False
) -> DataFrame:
    """Exact (or sketched) distinct count of several columns per key."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(*(count(F.col(c)).alias(f"n_{c}") for c in columns))


def distinct_sketches(df: DataFrame, keys: list[str], columns: list[str], lg_k: int = 12) -> DataFrame:
    """One sketch of the distinct values of each column per key, to be stored and merged later.

    A sketch takes at most 2 ** lg_k bytes and some more, whatever it has seen; the standard error of its
    count is about 1.04 / sqrt(2 ** lg_k). Values count by their text; nulls do not count.
    """
    sketches = (F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"sketch_{c}") for c in columns)
    return df.groupBy(*keys).agg(*sketches)


def merge_sketches(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Stored sketches put together over coarser keys; the result can be stored and merged again."""
    merged = (F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in columns)
    return sketches.groupBy(*keys).agg(*merged)


def sketched_counts(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct counts `n_<column>` in place of the sketches."""
    counts = {f"n_{c}": F.hll_sketch_estimate(f"sketch_{c}") for c in columns}
    return sketches.withColumns(counts).drop(*(f"sketch_{c}" for c in columns))


def usage_totals(
    df: DataFrame, prompt: str, reply: str, prompt_price: float, reply_price: float
) -> DataFrame:
    """Tokens sent and received (white-space tokens) and cost per thousand tokens."""

    def tokens(c: str) -> Column:
        words = F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\s+"), lambda w: w != "")
        return F.size(words)

    out = df.agg(
        F.count("*").alias("records_processed"),
        F.sum(tokens(prompt)).alias("tokens_prompted"),
        F.sum(tokens(reply)).alias("tokens_generated"),
    )
    cost = (
        F.col("tokens_prompted") / 1000 * prompt_price
        + F.col("tokens_generated") / 1000 * reply_price
    )
    return out.withColumn("run_cost_usd", cost)


def pairwise_label_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Equal, different, only a, only b, for two boolean columns."""
    left, right = F.col(a), F.col(b)
    return df.agg(
        F.count_if(left.eqNullSafe(right)).alias("n_equal"),
        F.count_if(~left.eqNullSafe(right)).alias("n_different"),
        F.count_if(left & ~right).alias("n_only_a"),
        F.count_if(~left & right).alias("n_only_b"),
    )
