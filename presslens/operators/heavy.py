"""Joins that spread frequent keys over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, VariantType

TRACKED = 10_000  # keys that a sketch follows
LISTED = 256  # keys that a sketch reports
SHARE = 0.005  # of a side's rows, from which a key counts as heavy
SMALL_BYTES = 64 << 20  # sources of a side that a task takes whole
MOST_SALTS = 256  # keys that a heavy key is split into, 4 a task where that is fewer


def source_bytes(df: DataFrame) -> int:
    """Bytes that df is read from, as far as the planner knows."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark's planner will broadcast df on its own in a join."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= int(most)


def heavy_keys(df: DataFrame, key: Column, share: float = SHARE, least: int = 2) -> list[int]:
    """Hashes (xxhash64) of the keys that hold at least `share` of the rows and `least` rows.

    Tasks sketch their rows and the sketches merge, so the pass shuffles one sketch a task. A
    sketch overstates counts at most, so every such key with a share over 1 / TRACKED is found.
    """
    hashed = df.select(F.xxhash64(key).alias("h"))
    row = hashed.agg(F.expr(f"approx_top_k(h, {LISTED}, {TRACKED})").alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in row.top or [] if t["count"] >= max(least, share * row.n)]


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns that Spark can hash."""
    hashable = [df[f.name] for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return F.xxhash64(*hashable) if hashable else F.lit(0).cast("long")


def split_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    how: str = "inner",
    salts: int | None = None,
    share: float = SHARE,
    also: Column | None = None,
) -> DataFrame:
    """`left.join(right, left_key == right_key, how)` for sides whose keys may be heavy.

    The rows of a heavy key of one side are dealt over `salts` tasks by a hash of the row, and the
    other side's rows with that key go to each of them; a key that is heavy on both sides is
    dealt on a grid of salts. All other keys join as they would anyway. With a side that Spark
    broadcasts nothing is dealt, as no key is shuffled then, nor with sides read from at most
    SMALL_BYTES each, where the hottest key fits a task. An outer, semi or anti join keeps
    every left row in one place, so there only the left side's heavy keys are dealt. Null keys
    match nothing. Equal copies of a whole row share a task. `also` restricts the matches. A key is
    dealt only if it has as many rows as salts, so the copies made are no more than the pairs.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how}")
    # Keys become columns: as expressions they would be computed anew in every comparison of a sort.
    left, right = left.withColumn("_left_key", left_key), right.withColumn("_right_key", right_key)
    left_key, right_key = F.col("_left_key"), F.col("_right_key")
    same = left_key == right_key
    small = source_bytes(left) <= SMALL_BYTES and source_bytes(right) <= SMALL_BYTES
    if small or is_broadcast(right) or (how == "inner" and is_broadcast(left)):
        return left.join(right, same if also is None else same & also, how).drop("_left_key", "_right_key")
    if salts is None:
        salts = min(MOST_SALTS, 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot_left = heavy_keys(left, left_key, share, salts)
    hot_right = heavy_keys(right, right_key, share, salts) if how == "inner" else []
    if not hot_left and not hot_right:
        return left.join(right, same if also is None else same & also, how).drop("_left_key", "_right_key")

    def dealt(df: DataFrame, key: Column, own: str, own_hot: list[int], other: str, other_hot: list[int]):
        h = F.xxhash64(key)
        salt = F.when(h.isin(own_hot), F.pmod(row_hash(df), F.lit(salts))).otherwise(0)
        copies = F.when(h.isin(other_hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        return df.withColumns({own: salt.cast("int"), other: copies}).withColumn(other, F.explode(other))

    a = dealt(left, left_key, "_la", hot_left, "_lb", hot_right)
    b = dealt(right, right_key, "_rb", hot_right, "_ra", hot_left)
    same = same & (F.col("_la") == F.col("_ra")) & (F.col("_lb") == F.col("_rb"))
    return a.join(b, same if also is None else same & also, how).drop("_la", "_lb", "_ra", "_rb", "_left_key", "_right_key")
