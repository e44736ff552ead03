"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Sources in code-point order, null last, have the
weights 1, 2, 3, 1, 2, 3, ... and share the words of all documents by weight; a target stops
at `most` times its source's size and the excess is shared again by weight until none is
above. A source then takes all its documents floor(target / size) times, and the rest of
its budget is fitted by a subset of them:

1. documents are counted by exact length, so a group of any size is one row;
2. a share of each length is taken in proportion, which leaves less than one document per
   length; lengths with the largest remainders are filled up to within `reserve` words;
3. a bounded knapsack (length, copies left) finds the sum nearest to what remains;
4. of each length that many documents are selected by a seeded hash. Lengths with very many
   documents are split by hash into buckets of about `BUCKET`; whole buckets go in order and
   only the one that holds the border is ranked, so no large group meets in one task.

Null text has size 0. Documents of size 0 take nothing. Repeated rows are documents of their
own; among equal rows any may be chosen, the result is the same. An empty table gives an
empty result. Reruns agree, since order comes from hashes of the rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from presslens.llm.rows import column, row_hash, unused
from presslens.operators.ranking import with_row_index
from presslens.sources.storage import write_table

WEIGHTS = (1, 2, 3)
MOST = 3
RESERVE = 1 << 16
BUCKET = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _row_hash(docs: DataFrame, seed: int) -> Column:
    return row_hash(docs, F.lit(seed))


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of sources (source, source_size), one row each.

    Every round is one aggregate over the sources and settles those above their limit.
    """
    ranked = with_row_index(sources, [F.asc_nulls_last("source")], "_row")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = ranked.withColumn("_w", F.get(cycle, F.pmod("_row", F.lit(len(weights))).cast("int")))
    ranked = write_table(ranked.withColumn("_most", most * F.col("source_size").cast("double")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    while True:
        held = F.coalesce(F.sum(F.when(capped, F.col("_most"))), F.lit(0.0))
        free = F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0.0))
        held, free, n = ranked.agg(held, free, F.count_if(capped)).first()
        unit = (total - held) / free if free else 0.0
        # A source once above its limit stays there, as the unit only grows.
        now = F.col("_w") * F.lit(unit) > F.col("_most")
        if ranked.filter(now | capped).count() == n:
            break
        capped = capped | now
    target = F.when(capped, F.col("_most")).otherwise(F.col("_w") * F.lit(unit))
    return ranked.select("source", "source_size", target.alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to budget."""
    take = np.zeros(len(lengths), np.int64)
    size = int((lengths * counts).sum())
    if budget <= 0 or size == 0:
        return take
    if budget >= size:
        return counts.copy()
    exact = counts * (budget / size)
    take = np.minimum(np.floor(exact).astype(np.int64), counts)
    left = budget - int((lengths * take).sum())
    for i in np.lexsort((lengths, take - exact)):
        if left < reserve:
            break
        if take[i] < counts[i] and lengths[i] <= left:
            take[i] += 1
            left -= int(lengths[i])
    over = left < 0  # rounding of very large numbers: give documents back
    while over and left < 0:
        i = int(np.argmax(np.where(take > 0, lengths, 0)))
        take[i] -= 1
        left += int(lengths[i])
    return take + _knapsack(lengths, counts - take, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack over sums up to a little beyond the budget; nearest sum, least on ties."""
    extra = np.zeros(len(lengths), np.int64)
    usable = (counts > 0) & (lengths > 0)
    if not usable.any():
        return extra
    top = budget + int(lengths[usable].max())  # the least sum over the budget lies below
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    item_of = np.full(top + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    for i in np.flatnonzero(usable & (lengths <= top)):
        left, copies = int(min(counts[i], top // lengths[i])), 1
        while left > 0:
            copies = min(copies, left)
            step = copies * int(lengths[i])
            if step <= top:
                fresh = np.zeros(top + 1, bool)
                fresh[step:] = reached[:-step]
                fresh &= ~reached
                item_of[fresh] = len(items)
                items.append((int(i), copies))
                reached |= fresh
            left -= copies
            copies *= 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at > 0:  # the sum before was reached by earlier items only
        i, copies = items[item_of[at]]
        extra[i] += copies
        at -= copies * int(lengths[i])
    return extra


def _fit(reserve: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        budget = int(round(float(rows["rest"].iloc[0])))
        take = fit_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), budget, reserve)
        return rows[["source", "size", "n"]].assign(take=take)

    return run


def mixture(
    docs: DataFrame,
    keep: list[str],
    weights=WEIGHTS,
    most: int = MOST,
    seed: int = 42,
    reserve: int = RESERVE,
) -> DataFrame:
    """The columns `keep` of every document with size, source_size, target and taken.

    `taken` is the words that the mix takes from the document, repeats counted.
    """
    sized = docs.select(
        *(column(c).alias(f"_k{i}") for i, c in enumerate(keep)),
        "source",
        n_words("text").alias("size"),
        _row_hash(docs, seed).alias("_order"),
    )
    sized = write_table(sized, "sized")
    lengths = write_table(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = write_table(source_targets(totals, weights, most), "targets")
    # try_divide: a source without words has target 0
    passes = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    budgets = targets.withColumn("passes", F.least(passes, F.lit(most)))
    budgets = budgets.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    counted = _null_safe(lengths.filter("size > 0"), budgets.select("source", "rest"), ["source"])
    plan = counted.groupBy("source").applyInPandas(
        _fit(reserve), "source string, size long, n long, take long"
    )
    plan = plan.withColumn("buckets", F.ceil(F.col("n") / BUCKET).cast("long"))
    plan = write_table(plan.filter("take > 0"), "plan")

    dealt = sized.withColumn("_source", F.struct("source"))
    dealt = _null_safe(dealt, plan.drop("n"), ["source", "size"], "left")
    bucket = F.pmod(F.xxhash64("_order"), F.coalesce("buckets", F.lit(1)))
    dealt = write_table(dealt.withColumn("_bucket", bucket).drop("_source"), "dealt")
    group = ["source", "size"]
    filled = dealt.filter("take is not null").groupBy(*group, "_bucket").agg(
        F.count("*").alias("_n"), F.first("take").alias("_take")
    )
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    filled = write_table(
        filled.select(*group, "_bucket", F.greatest(F.lit(0), F.col("_take") - F.col("_before")).alias("_room"), "_n"),
        "filled",
    )
    dealt = _null_safe(dealt, filled, [*group, "_bucket"], "left")
    rank = F.row_number().over(
        Window.partitionBy(*group, "_bucket").orderBy("_order", *(f"_k{i}" for i in range(len(keep))))
    )
    whole = F.coalesce(F.col("_room") >= F.col("_n"), F.lit(False))
    border = F.coalesce((F.col("_room") > 0) & (F.col("_room") < F.col("_n")), F.lit(False))
    ranked = dealt.filter(border).withColumn("_more", (rank <= F.col("_room")).cast("long"))
    settled = dealt.filter(~border).withColumn("_more", whole.cast("long"))
    chosen = settled.unionByName(ranked)
    chosen = _null_safe(chosen, budgets.drop("rest"), ["source"])
    return chosen.select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)),
        F.col("_order").alias("_row"),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("passes") + F.col("_more"))).alias("taken"),
        F.when(F.col("size") > 0, F.col("passes") + F.col("_more")).otherwise(1).alias("copies"),
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null source equals null, without a null-safe operator's limits."""
    names = {k: f"_r_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    condition = [left[k].eqNullSafe(right[n]) for k, n in names.items()]
    return left.join(right, condition, how).drop(*names.values())


def mix(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """Documents of the mix with size, source_size, target, taken and copies beside their columns.

    A row stands for `copies` copies; documents without a copy are gone. Documents of size 0
    stay once. Decisions are made on thin rows and meet the texts once, by a hash of the
    whole row; equal rows share the copies of that hash out among themselves. Columns of docs
    with one of the five names are replaced; all others, of any type and name, are kept.
    """
    given = {"size", "source_size", "target", "taken", "copies"}
    docs = docs.drop(*(column(c) for c in docs.columns if c.lower() in given))
    row, copies, rows = unused(docs, "_row", "_copies", "_rows")
    decided = mixture(docs, [], seed=seed, **options).groupBy(F.col("_row").alias(row)).agg(
        F.first("size").alias("size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum("copies").alias(copies),
        F.count("*").alias(rows),
    )
    decided = write_table(decided.filter(F.col(copies) > 0), "decided")
    mixed = docs.withColumn(row, _row_hash(docs, seed)).join(decided, row)
    nth = F.row_number().over(Window.partitionBy(row).orderBy(row))
    extra = (nth <= F.col(copies) % F.col(rows)).cast("long")
    mixed = mixed.withColumn("copies", F.floor(F.col(copies) / F.col(rows)) + extra)
    mixed = mixed.withColumn("taken", F.col("size") * F.col("copies")).filter("copies > 0")
    return mixed.drop(row, copies, rows)
