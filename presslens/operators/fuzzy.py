"""Fuzzy name join: token-sort ratio at or above a threshold, exact at any size.

ratio = 200 * LCS / (len a + len b), so a match at threshold t allows at most
d = (len a + len b) * (1 - t/100) insertions and deletions. Cut the shorter name into
d + 1 pieces (segment filter of PassJoin, Li et al., VLDB 2011). Take the first p for which
pieces 0..p hold at most p changes: piece p is unchanged, exactly p insertions or deletions
lie before it and at most d - p behind it. So it is found in the longer name at a shift of
p, p - 2, ..., -p, and no further from the length difference than d - p. That makes
candidates an equi-join on lengths, piece number and piece text.
"""

from __future__ import annotations

import struct
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import normalise_name, sorted_tokens
from presslens.sources.storage import cut_lineage

MIN_THRESHOLD = 70  # below, a name may need more pieces than it has characters


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine-word style pass per character of b."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hits = free & positions.get(ch, 0)
        free = ((free + hits) | (free - hits)) & full
    return len(a) - free.bit_count()


def indel_ratio(a: Column, b: Column) -> Column:
    """200 * LCS / (len a + len b), computed per Arrow batch."""

    @F.pandas_udf("double")
    def ratio(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(
            [200.0 * lcs_length(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(xs, ys)],
            dtype="float64",
        )

    return ratio(a, b)


def _allowed(total: Column, threshold: float) -> Column:
    return F.floor(total * (100 - threshold) / 100 + 1e-9).cast("int")


def _pieces(names: DataFrame, threshold: float, partner: str) -> DataFrame:
    """One row per name, partner length and piece of the shorter of the two.

    `partner` says which side the other name is on. The rows come from explodes, so every
    derived number is computed once and stays in generated code.
    """
    length = F.length("name")
    stretch = (200 - threshold) / threshold
    if partner == "long":
        others = F.sequence(length, F.floor(length * stretch + 1e-9).cast("int"))
        out = names.select("name", "bag", length.alias("len_short"), F.explode(others).alias("len_long"))
    else:
        others = F.sequence(F.ceil(length / stretch - 1e-9).cast("int"), length)
        out = names.select("name", "bag", F.explode(others).alias("len_short"), length.alias("len_long"))
    changes = _allowed(F.col("len_short") + F.col("len_long"), threshold)
    out = out.withColumn("changes", changes).filter("changes >= len_long - len_short")
    out = out.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("changes"))))
    # The last pieces take the extra characters.
    pieces = F.col("changes") + 1
    small = F.floor(F.col("len_short") / pieces).cast("int")
    n_small = pieces - F.col("len_short") % pieces
    start = F.col("piece") * small + F.greatest(F.col("piece") - n_small, F.lit(0))
    size = F.when(F.col("piece") < n_small, small).otherwise(small + 1)
    return out.select("name", "bag", "len_short", "len_long", "changes", "piece", start.alias("start"), size.alias("size"))


def _signature(text: Column) -> Column:
    """Lengths, piece number and piece as one number. Chance collisions only add candidates."""
    return F.xxhash64("len_short", "len_long", "piece", text).alias("signature")


def _short_signatures(names: DataFrame, threshold: float) -> DataFrame:
    out = _pieces(names, threshold, "long")
    text = F.substring(F.col("name"), F.col("start") + 1, F.col("size"))
    return out.select(_signature(text), F.col("name").alias("short"), F.col("bag").alias("bag_short"))


def _long_signatures(names: DataFrame, threshold: float) -> DataFrame:
    out = _pieces(names, threshold, "short")
    extra = F.col("len_long") - F.col("len_short")
    behind = F.col("changes") - F.col("piece")
    low = F.greatest(-F.col("piece"), extra - behind, -F.col("start"))
    high = F.least(F.col("piece"), extra + behind, F.col("len_long") - F.col("size") - F.col("start"))
    # Shifts have the parity of the piece number.
    first = low + F.pmod(low - F.col("piece"), F.lit(2))
    out = out.select("*", first.alias("first"), high.alias("last")).filter("first <= last")
    out = out.withColumn("shift", F.explode(F.sequence("first", "last", F.lit(2))))
    text = F.substring(F.col("name"), F.col("start") + F.col("shift") + 1, F.col("size"))
    return out.select(_signature(text), F.col("name").alias("long"), F.col("bag").alias("bag_long"))


def _bag(name: Column) -> Column:
    """Characters counted in 32 classes of at most 8, as 256 bits of which a class sets its lowest.

    An inserted or deleted character changes one count by one, so at most one bit.
    """

    @F.pandas_udf("struct<w0:bigint,w1:bigint,w2:bigint,w3:bigint>")
    def bag(names: pd.Series) -> pd.DataFrame:
        rows = []
        for text in names:
            counts = [0] * 32
            for ch in text:
                counts[ord(ch) % 32] += 1
            bits = b"".join(((1 << min(n, 8)) - 1).to_bytes(1, "little") for n in counts)
            rows.append(struct.unpack("<4q", bits))
        return pd.DataFrame(rows, columns=["w0", "w1", "w2", "w3"])

    return bag(name)


def _distinct_names(a: DataFrame, b: DataFrame | None) -> DataFrame:
    """Distinct non-empty names with their bag and the sides they occur on, written once.

    A name is small but grows into many signatures, so names are dealt over all tasks by a key that is
    not the one they were grouped by; by that one, tasks would be merged by size before they grow.
    """
    spark = a.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    names = a.select("name", F.lit(True).alias("in_a"), F.lit(b is None).alias("in_b"))
    if b is not None:
        names = names.unionByName(b.select("name", F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    known = names.filter("name != ''").groupBy("name").agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    dealt = known.repartition(parts, F.xxhash64("name"))
    return cut_lineage(dealt.withColumn("bag", _bag(F.col("name"))))


def _close_pairs(short: DataFrame, long: DataFrame, threshold: float) -> DataFrame:
    """(short, long) that share a signature and may be alike enough by their bags and by Levenshtein,
    which never exceed the insert/delete distance.

    Signatures outgrow what the planner knows of names, so they are merged, not broadcast.
    """
    pairs = _short_signatures(short, threshold).hint("merge").join(_long_signatures(long, threshold), "signature")
    limit = _allowed(F.length("short") + F.length("long"), threshold)
    differ = reduce(
        Column.__add__, (F.bit_count(F.col(f"bag_short.w{i}").bitwiseXOR(F.col(f"bag_long.w{i}"))) for i in range(4))
    )
    pairs = pairs.filter((F.length("short") <= F.length("long")) & (differ <= limit))
    near = F.call_function("levenshtein", F.col("short"), F.col("long"), limit) >= 0
    return pairs.filter(near).select("short", "long")


def match_names(a: DataFrame, b: DataFrame | None, threshold: float = 90) -> DataFrame:
    """(a, b, score) for all pairs of distinct non-empty names with ratio >= threshold.

    Inputs have one column `name`, already reduced to sorted tokens. Without b the names of
    a are matched among themselves, each pair once with a no longer than b.
    """
    if threshold < MIN_THRESHOLD:
        raise ValueError(f"threshold must be at least {MIN_THRESHOLD}")
    names = _distinct_names(a, b)
    forward = _close_pairs(names.filter("in_a"), names.filter("in_b"), threshold)
    pairs = forward.select(F.col("short").alias("a"), F.col("long").alias("b"))
    if b is not None:
        # Pairs of names that are on both sides came forward, and serve in either order.
        forward = cut_lineage(forward.distinct())
        pairs = forward.select(F.col("short").alias("a"), F.col("long").alias("b"))
        both = names.filter("in_a and in_b")
        shared = [both.select(F.col("name").alias(c)) for c in ("short", "long")]
        turned = forward.join(shared[0], "short", "left_semi").join(shared[1], "long", "left_semi")
        for sides in (("in_b and not in_a", "in_a"), ("in_a and in_b", "in_a and not in_b")):
            short, long = (names.filter(side) for side in sides)
            if not short.isEmpty() and not long.isEmpty():
                turned = turned.unionByName(_close_pairs(short, long, threshold))
        pairs = pairs.union(turned.select(F.col("long").alias("a"), F.col("short").alias("b")))
    pairs = pairs.distinct()
    scored = pairs.withColumn("score", indel_ratio(F.col("a"), F.col("b")))
    return scored.filter(F.col("score") >= threshold)


def join_fuzzy(
    articles: DataFrame,
    companies: DataFrame,
    mention: str,
    name: str,
    threshold: float = 90,
    out: str = "match_score",
) -> DataFrame:
    """Inner join on the token-sort ratio of normalised names; matching itself runs on
    distinct names."""
    left = articles.withColumn("_a", sorted_tokens(normalise_name(F.col(mention))))
    right = companies.withColumn("_b", sorted_tokens(normalise_name(F.col(name))))
    matches = match_names(
        left.select(F.col("_a").alias("name")), right.select(F.col("_b").alias("name")), threshold
    ).select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("score").alias(out))
    return left.join(matches, "_a").join(right, "_b").drop("_a", "_b")
