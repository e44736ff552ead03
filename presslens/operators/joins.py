"""Name joins, outer fills and rater alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import lower_key, normalise_name
from presslens.operators.dedup import keep_first, members_of_duplicate_groups
from presslens.operators.heavy import split_join


def join_ci_exact(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Inner join on lower-cased names; rows of frequent names spread over tasks."""
    return split_join(left, right, lower_key(left[left_on]), lower_key(right[right_on]))


def join_normalised(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, match_empty: bool = False
) -> DataFrame:
    """Inner join on names without case and punctuation; rows of frequent names spread over tasks."""
    key, other = normalise_name(left[left_on]), normalise_name(right[right_on])
    if not match_empty:  # names of punctuation match nothing and need not be dealt
        key, other = (F.when(k != "", k) for k in (key, other))
    return split_join(left, right, key, other)


def left_join_normalised(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, match_empty: bool = False
) -> DataFrame:
    """join_normalised keeping every left row.

    A null name normalises to nothing, as one of punctuation does. Left rows that can match
    nothing get a key of their own (no normalised name holds a zero character), so they are
    spread over the tasks of the join.
    """
    key = normalise_name(left[left_on])
    if not match_empty:
        row = F.xxhash64(*(left[c] for c in left.columns)).cast("string")
        key = F.when(key != "", key).otherwise(F.concat(F.lit("\0"), row))
    return split_join(left, right, key, normalise_name(right[right_on]), "left")


def join_ambiguous_names(
    articles: DataFrame, companies: DataFrame, mention: str, name: str
) -> DataFrame:
    """join_ci_exact restricted to companies whose name is shared."""
    return join_ci_exact(articles, members_of_duplicate_groups(companies, [name]), mention, name)


def _attach_best(
    articles: DataFrame, keyed: DataFrame, mention: str, size: str | None, tiebreak: list[str]
) -> DataFrame:
    """Join articles to companies carrying a `_key`.

    With a size the largest company per distinct mention is chosen before the articles
    are touched, so a mention shared by many articles and companies never fans out.
    """
    articles = articles.withColumn("_mention", normalise_name(F.col(mention)))
    if size is not None:
        wanted = articles.select(F.col("_mention").alias("_key")).distinct()
        keyed = keep_first(
            keyed.filter(F.col(size).isNotNull()).join(wanted, "_key", "left_semi"),
            ["_key"],
            [F.desc(size), *tiebreak],
        )
    return split_join(articles, keyed, F.col("_mention"), F.col("_key")).drop("_mention", "_key")


def join_name_prefix(
    articles: DataFrame,
    companies: DataFrame,
    mention: str,
    name: str,
    size: str | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Company name starts with the mention and a blank.

    Every prefix of a name that ends before a blank becomes a row, which turns the
    prefix test into an equi-join. Frequent mentions and prefixes shared by many names are
    dealt over tasks.
    """
    tokens = F.split(normalise_name(F.col(name)), " ")
    prefixes = F.when(
        F.size(tokens) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - 1),
            lambda n: F.array_join(F.slice(tokens, F.lit(1), n), " "),
        ),
    )
    keyed = companies.withColumn("_key", F.explode(prefixes))
    return _attach_best(articles, keyed, mention, size, tiebreak or [name])


def join_domain_prefix(
    articles: DataFrame,
    companies: DataFrame,
    mention: str,
    domain: str,
    size: str | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Company domain starts with the mention and a dot (a mention holds no dot)."""
    keyed = companies.filter(F.col(domain).contains(".")).withColumn(
        "_key", F.substring_index(domain, ".", 1)
    )
    return _attach_best(articles, keyed, mention, size, tiebreak or [domain])


def outer_fill(tables: list[DataFrame], key: str, default=0) -> DataFrame:
    """Full outer join of several count tables on one key, missing counts filled."""
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), tables)
    return joined.na.fill(default, subset=[c for c in joined.columns if c != key])


def natural_join_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all common columns, null matching null."""
    common = [c for c in left.columns if c in right.columns]
    condition = reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in common))
    return left.join(right, condition).select(
        *(left[c] for c in left.columns), *(right[c] for c in right.columns if c not in common)
    )


def anti_by_values(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """Rows whose value does not occur in other; null values stay."""
    return df.join(other.select(col).distinct(), col, "left_anti")


def left_join_fill(base: DataFrame, extras: list[DataFrame], keys: list[str], default=0) -> DataFrame:
    """Successive left joins on the same keys, missing numbers filled."""
    joined = reduce(lambda a, b: a.join(b, keys, "left"), extras, base)
    return joined.na.fill(default)


def align_raters(
    raters: dict[str, DataFrame], keys: list[str], labels: list[str] | None = None
) -> DataFrame:
    """Rows rated by everyone, label columns suffixed with the rater name."""
    if labels is None:
        shared = set.intersection(*(set(df.columns) for df in raters.values()))
        labels = sorted(shared - set(keys))
    renamed = [
        df.select(*keys, *(F.col(c).alias(f"{c}_{rater}") for c in labels))
        for rater, df in raters.items()
    ]
    return reduce(lambda a, b: a.join(b, keys), renamed)


def overlap_counts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Size of the inner join and rows of each side beyond it.

    The join size is the sum of products of the per-key counts, so no pair is built.
    """
    counts = (
        a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
        .unionByName(b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        .groupBy(*keys)
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )
    keyed = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    both = F.coalesce(F.sum(F.when(keyed, F.col("_a") * F.col("_b"))), F.lit(0))
    return counts.agg(
        both.cast("bigint").alias("in_both"),
        (F.sum("_a") - both).cast("bigint").alias("only_a"),
        (F.sum("_b") - both).cast("bigint").alias("only_b"),
    )


def broadcast_lookup(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a lookup table; Spark broadcasts it if its measured bytes allow."""
    return df.join(lookup, on, "left")


def ratio_by_key(
    part: DataFrame, whole: DataFrame, key: str, part_count: str, whole_count: str
) -> DataFrame:
    """Share of part in whole per key, also as percent text (half-even rounding).

    Both are null where the whole is 0.
    """
    ratio = F.try_divide(F.coalesce(F.col(part_count), F.lit(0)), F.col(whole_count))
    return (
        whole.join(part, key, "left")
        .na.fill({part_count: 0})
        .withColumn("ratio", ratio)
        .withColumn(
            "percent", F.concat(F.bround(F.col("ratio") * 100, 2).cast("string"), F.lit("%"))
        )
    )
