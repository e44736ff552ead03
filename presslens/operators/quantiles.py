"""Exact percentiles of groups of any size, by radix selection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType

from presslens.sources.storage import write_table

# Bits of the key below each round's bucket: 22, 21 and 21 bits are decided in turn.
SHIFTS = (42, 21, 0)
# Rows of a bucket up to which the next round decides all bits that are left.
LAST_BUCKET = 1 << 20


@F.arrow_udf(LongType())
def order_key(values: pa.Array) -> pa.Array:
    """64-bit integers in the order of the doubles; NaN is one value above all others."""
    x = np.asarray(values.fill_null(0.0), np.float64) + 0.0  # a negative zero equals zero
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    keys = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
    return pa.array(np.where(np.isnan(x), np.int64(0x7FFFFFFFFFFFFFFF), keys))


@F.arrow_udf(DoubleType())
def key_value(keys: pa.Array) -> pa.Array:
    """The doubles that order_key made the keys of."""
    k = np.asarray(keys.fill_null(0), np.int64)
    x = (k ^ ((k >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)
    return pa.array(np.where(k == np.int64(0x7FFFFFFFFFFFFFFF), np.nan, x))


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null; right's keys are called _r<key>."""
    condition = F.lit(True)
    for c in keys:
        condition = condition & left[c].eqNullSafe(right[f"_r{c}"])
    return left.join(right, condition, how).drop(*(f"_r{c}" for c in keys))


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_r{c}" for c in keys})


def select_ranks(keyed: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """(keys, wanted's other columns, _value): the key at 0-based `_rank` of each group of `keyed`.

    `keyed` has the group columns and `_key`. A round counts rows by the next bits of their
    keys, among the rows whose bits so far are those of a wanted rank; running sums over the
    buckets (at most 2**22 a group, however many rows) tell the bucket of each rank. Tasks add
    up their counts before the shuffle, so a group with most rows weighs no more than another.
    """
    state, above = wanted, None
    for shift in SHIFTS:
        if above is not None and shift and (state.agg(F.max("_rows")).first()[0] or 0) <= LAST_BUCKET:
            continue
        rows = keyed.withColumn("_bucket", F.shiftright("_key", shift))
        if above is None:
            known = keys
        else:
            rows = rows.withColumn("_prefix", F.shiftright("_key", above))
            known = [*keys, "_prefix"]
            chosen = _renamed(state.select(*known).distinct(), known)
            rows = _matched(rows, chosen, known, "left_semi")
        counts = rows.groupBy(*known, "_bucket").agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*known).orderBy("_bucket"))
        counts = _renamed(counts.withColumn("_upto", upto), known)
        found = _matched(state.drop("_rows"), counts, known, "inner")
        found = found.filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
        found = found.withColumn("_rank", F.col("_rank") - F.col("_upto") + F.col("_n")).drop("_prefix", "_upto")
        state = write_table(found.withColumnsRenamed({"_bucket": "_prefix", "_n": "_rows"}), "ranks")
        above = shift
    return state.withColumnRenamed("_prefix", "_value").drop("_rank", "_rows")


def exact_percentiles(
    df: DataFrame, groups: list[str], col: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linear-interpolated percentiles (as pandas and `percentile`) per group.

    Neither all values of a group nor its distinct ones are gathered: three counting passes over
    64-bit keys in the order of the values, two where buckets are small, narrow every wanted rank to
    one value. Nulls do not
    count; NaN counts as the largest value, as in Spark's `percentile`, whatever the order of
    rows. Rows with a null in a group column are a group of their own. A group without values
    has no row, nor does a table without values when there are no groups.
    """
    names = list(probabilities)
    if not names:
        raise ValueError("no percentile asked for")
    keys = groups or ["_all"]
    rows = df if groups else df.withColumn("_all", F.lit(1))
    x = F.col(col).cast("double")
    rows = rows.filter(x.isNotNull()).select(*keys, order_key(x).alias("_key"))
    keyed = write_table(rows, "order-keys")

    sizes = keyed.groupBy(*keys).agg(F.count("*").alias("_n"))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(probabilities[n])).alias("p")) for i, n in enumerate(names))))
    asked = sizes.withColumn("_a", each).select(
        *keys, F.col("_a.i").alias("_i"), (F.col("_a.p") * (F.col("_n") - 1)).alias("_at")
    )
    ends = F.explode(F.array(F.struct(F.lit(0).alias("e"), F.floor("_at").alias("r")), F.struct(F.lit(1).alias("e"), F.ceil("_at").alias("r"))))
    wanted = asked.withColumn("_e", ends).select(
        *keys, "_i", F.col("_e.e").alias("_end"), F.col("_e.r").alias("_rank"), (F.col("_at") - F.floor("_at")).alias("_w")
    )
    found = select_ranks(keyed, keys, wanted)
    found = found.select(*keys, "_i", "_end", "_w", key_value("_value").alias("_x"))
    side = lambda e: F.max(F.when(F.col("_end") == e, F.col("_x")))
    pairs = found.groupBy(*keys, "_i", "_w").agg(side(0).alias("_v0"), side(1).alias("_v1"))
    first, second = F.col("_v0"), F.col("_v1")
    q = F.when(first == second, first).otherwise(first + (second - first) * F.col("_w"))
    values = pairs.withColumn("_q", q)
    out = values.groupBy(*keys).agg(
        *(F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names))
    )
    return out if groups else out.drop("_all")
