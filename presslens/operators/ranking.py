"""Top-k, row indexes, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from presslens.sources.storage import cut_lineage

MOST_SKIPPED = 100_000  # rows that a task keeps to find the last skipped one


def top_n_by_count(df: DataFrame, col: str, n: int, ascending: bool = False) -> DataFrame:
    """Most (or least) frequent non-null values, ties by name."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    return counts.orderBy(F.asc("count") if ascending else F.desc("count"), col).limit(n)


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """First k rows per group; each map task keeps at most k rows per group."""
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, number).filter(F.col(rank) <= k)


def top_k_per_top_group(
    df: DataFrame, group: str, member: str, groups: int = 10, members: int = 5
) -> DataFrame:
    """The most frequent members inside each of the most frequent groups."""
    counts = (
        df.na.drop(subset=[group, member]).groupBy(group, member).agg(F.count("*").alias("count"))
    )
    largest = (
        counts.groupBy(group)
        .agg(F.sum("count").alias("_total"))
        .orderBy(F.desc("_total"), group)
        .limit(groups)
        .select(group)
    )
    return top_k_per_group(
        counts.join(F.broadcast(largest), group, "left_semi"),
        [group],
        [F.desc("count"), member],
        members,
    )


def best_per_group(df: DataFrame, group: str, member: str, value: str) -> DataFrame:
    """Member with the largest value in each group, ties by name."""
    return top_k_per_group(df, [group], [F.desc(value), member], 1).drop("rank")


def with_row_index(df: DataFrame, order: list[Column | str], out: str = "row_index") -> DataFrame:
    """Dense 0-based position in a total order, without a single-task window.

    Rows are range-partitioned and sorted, written once so that partition numbers are
    stable, and shifted by the sizes of the preceding partitions.
    """
    bits = 33  # fixed value: monotonically_increasing_id keeps the position in 33 bits
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    numbered = placed.withColumn("_id", F.monotonically_increasing_id()).withColumns(
        {
            "_part": F.shiftright("_id", bits).cast("int"),
            "_pos": F.col("_id").bitwiseAND(F.lit((1 << bits) - 1)),
        }
    )
    # One row per partition, so the unpartitioned window below is a handful of rows.
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_part",
        (
            F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        ).alias("_offset"),
    )
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.coalesce("_offset", F.lit(0)) + F.col("_pos"))
        .drop("_id", "_part", "_pos", "_offset")
    )


def assign_chunks(df: DataFrame, order: list[Column | str], n: int, out: str = "chunk") -> DataFrame:
    """Chunk number for consecutive runs of n rows."""
    if n <= 0:
        raise ValueError("chunk size must be positive")
    indexed = with_row_index(df, order, "_row")
    return indexed.withColumn(out, F.floor(F.col("_row") / n)).drop("_row")


def assign_shards(df: DataFrame, order: list[Column | str], k: int, out: str = "shard") -> DataFrame:
    """k contiguous shards of equal size; the last takes the remainder."""
    if k <= 0:
        raise ValueError("shard count must be positive")
    indexed = with_row_index(df, order, "_row")
    size = F.greatest(F.floor(indexed.agg(F.count("*")).scalar() / k), F.lit(1))
    shard = F.least(F.floor(F.col("_row") / size), F.lit(k - 1))
    return indexed.withColumn(out, shard.cast("bigint")).drop("_row")


def skip_data_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """Drop the first n rows of the given order.

    With column names as order (ascending, nulls first) and a moderate n the nth row is found by
    a top-n, which keeps n keys per task, and the table is filtered by it: nothing is sorted
    or moved. Only rows that tie with the nth one are numbered, where some of them stay.
    Other orders number all rows.
    """
    if n <= 0:
        return df
    if n > MOST_SKIPPED or not all(isinstance(c, str) for c in order):
        return with_row_index(df, order, "_row").filter(F.col("_row") >= n).drop("_row")
    keys = [f"_o{i}" for i in range(len(order))]
    thin = df.select(*(F.col(c).alias(k) for c, k in zip(order, keys)))
    last = thin.orderBy(*keys).offset(n - 1).limit(1).select(F.struct(*keys).alias("_last"))
    last = cut_lineage(last)
    border = last.scalar()
    before = F.count_if(F.struct(*keys) < border)
    tied = F.count_if(F.struct(*keys) == border)
    before, tied = thin.agg(before, tied).first()
    if tied == 0:  # fewer than n rows
        return df.limit(0)
    own = F.struct(*(F.col(c).alias(k) for c, k in zip(order, keys)))
    later = df.filter(own > border)
    if before + tied == n:
        return later
    ties = with_row_index(df.filter(own == border), order, "_row")
    return later.unionByName(ties.filter(F.col("_row") >= n - before).drop("_row"))


def sort_by_key(df: DataFrame, key: Column, *tiebreak: str) -> DataFrame:
    return df.orderBy(key, *tiebreak)


def ordinal(col: str, levels: list[str]) -> Column:
    """Position of a value in a fixed list of levels; unknown values sort last."""
    position = F.array_position(F.array(*(F.lit(v) for v in levels)), F.col(col))
    return F.when(position > 0, position).otherwise(len(levels) + 1).cast("int")


def sort_by_ordinal(df: DataFrame, col: str, levels: list[str], *tiebreak: str) -> DataFrame:
    return df.orderBy(ordinal(col, levels), *tiebreak)


def sort_multi(df: DataFrame, order: list[Column | str], limit: int | None = None) -> DataFrame:
    out = df.orderBy(*order)
    return out if limit is None else out.limit(limit)


def _hash_order(keys: list[str], seed: int) -> Column:
    return F.xxhash64(*keys, F.lit(seed))


def shuffle_seeded(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """Reproducible shuffle: order by a seeded hash of the key."""
    return df.orderBy(_hash_order(keys, seed), *keys)


def sample_n(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    return shuffle_seeded(df, keys, seed).limit(n)


def train_test_split(
    df: DataFrame, keys: list[str], fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint split by a hash bucket of the key, stable under repartitioning."""
    bucket = F.pmod(_hash_order(keys, seed), F.lit(1_000_000)) / 1_000_000
    return df.filter(bucket < fraction), df.filter(bucket >= fraction)
