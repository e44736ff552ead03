"""Rater agreement and classifier scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import to_bool


def fleiss_pivot(
    raters: list[DataFrame], keys: list[str], col: str, labels: list[str]
) -> DataFrame:
    """Item by label counts over all raters.

    Items with fewer ratings than the fullest one are topped up: each label in turn gets
    the integer share of what is still missing, the last label gets the remainder.
    """
    votes = reduce(
        lambda a, b: a.unionByName(b),
        (r.select(*keys, F.col(col).cast("string").alias("_label")) for r in raters),
    )
    counted = votes.groupBy(*keys).agg(
        *(F.count_if(F.col("_label") == F.lit(v)).alias(v) for v in labels)
    )
    total = sum((F.col(f"`{v}`") for v in labels), F.lit(0))
    fullest = counted.agg(F.max(total)).scalar()
    out = counted.withColumn("_missing", fullest - total)
    for label in labels:
        share = F.floor(F.col("_missing") / len(labels))
        out = out.withColumns({label: F.col(f"`{label}`") + share, "_missing": F.col("_missing") - share})
    last = labels[-1]
    return out.withColumn(last, F.col(f"`{last}`") + F.col("_missing")).drop("_missing")


def fleiss_kappa(table: DataFrame, labels: list[str]) -> DataFrame:
    """Kappa of an item by label table with equal row sums; one pass, null without ratings."""
    cells = [F.col(f"`{v}`").cast("double") for v in labels]
    ratings = sum(cells, F.lit(0.0))
    squares = sum((c * c for c in cells), F.lit(0.0))
    agreement = F.try_divide(squares - ratings, ratings * (ratings - 1))
    sums = table.agg(
        F.avg(agreement).alias("_p"),
        F.sum(ratings).alias("_all"),
        *(F.sum(c).alias(f"_s{i}") for i, c in enumerate(cells)),
    )
    shares = [F.try_divide(f"_s{i}", "_all") for i in range(len(labels))]
    chance = sum((F.pow(s, F.lit(2)) for s in shares), F.lit(0.0))
    return sums.select(F.try_divide(F.col("_p") - chance, 1 - chance).alias("kappa"))


def _ratio(part: Column, whole: Column) -> Column:
    """Division in which an empty denominator scores 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _scores(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    p, r = _ratio(tp, predicted), _ratio(tp, actual)
    return {"precision": p, "recall": r, "f1": _ratio(2 * p * r, p + r)}


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Scores per class plus macro and weighted averages; support as row counts."""
    pairs = df.groupBy(
        F.col(truth).cast("string").alias("_t"), F.col(predicted).cast("string").alias("_p")
    ).agg(F.count("*").alias("_n"))
    sides = F.array(
        F.struct(F.col("_t").alias("label"), F.lit(1).alias("_is_true"), F.lit(0).alias("_is_pred")),
        F.struct(F.col("_p").alias("label"), F.lit(0).alias("_is_true"), F.lit(1).alias("_is_pred")),
    )
    per_class = (
        pairs.select("_n", F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0).alias("_hit"), F.inline(sides))
        .groupBy("label")
        .agg(
            F.sum(F.col("_hit") * F.col("_is_true")).alias("_tp"),
            F.sum(F.col("_n") * F.col("_is_pred")).alias("_predicted"),
            F.sum(F.col("_n") * F.col("_is_true")).alias("support"),
        )
    )
    per_class = per_class.select(
        "label",
        *(c.alias(n) for n, c in _scores(F.col("_tp"), F.col("_predicted"), F.col("support")).items()),
        "support",
    )
    metrics = ["precision", "recall", "f1"]
    macro = per_class.agg(
        *(F.avg(m).alias(m) for m in metrics), F.sum("support").alias("support")
    ).withColumn("label", F.lit("macro avg"))
    weighted = per_class.agg(
        *((F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in metrics),
        F.sum("support").alias("support"),
    ).withColumn("label", F.lit("weighted avg"))
    return per_class.unionByName(macro).unionByName(weighted)


def label_metrics(aligned: DataFrame, labels: list[str], a: str, b: str) -> DataFrame:
    """Per boolean label of two raters: scores, support, agreement and kappa, in one pass.

    `aligned` holds `<label>_<a>` and `<label>_<b>`; rater a is the truth. Support is the
    larger number of positives.
    """
    cells = F.array(
        *(
            F.struct(
                F.lit(v).alias("label"),
                F.coalesce(F.col(f"{v}_{a}"), F.lit(False)).alias("_a"),
                F.coalesce(F.col(f"{v}_{b}"), F.lit(False)).alias("_b"),
            )
            for v in labels
        )
    )
    counts = (
        aligned.select(F.inline(cells))
        .groupBy("label")
        .agg(
            F.count_if(F.col("_a") & F.col("_b")).alias("_tp"),
            F.count_if(F.col("_a")).alias("_pa"),
            F.count_if(F.col("_b")).alias("_pb"),
            F.count_if(F.col("_a") == F.col("_b")).alias("agree"),
            F.count("*").alias("_n"),
        )
    )
    observed = F.col("agree") / F.col("_n")
    positive = (F.col("_pa") + F.col("_pb")) / (2 * F.col("_n"))
    chance = positive * positive + (1 - positive) * (1 - positive)
    return counts.select(
        "label",
        F.try_divide(observed - chance, 1 - chance).alias("kappa"),
        *(c.alias(n) for n, c in _scores(F.col("_tp"), F.col("_pb"), F.col("_pa")).items()),
        F.greatest("_pa", "_pb").alias("support"),
        "agree",
        (F.col("_n") - F.col("agree")).alias("disagree"),
    )


def overall_scores(
    report: DataFrame, category_kappa: DataFrame, metrics: DataFrame, n_labels: int
) -> DataFrame:
    """Category and label scores averaged by the number of categories and labels."""
    classes = report.filter(~F.col("label").isin("macro avg", "weighted avg"))
    n_cat = classes.agg(F.count("*")).scalar()
    cat_f1 = report.filter("label = 'macro avg'").select("f1").scalar()
    cat_irr = category_kappa.select("kappa").scalar()
    means = metrics.agg(F.avg("f1").alias("labels_f1"), F.avg("kappa").alias("labels_irr"))
    return means.select(
        cat_f1.alias("category_f1"),
        cat_irr.alias("category_irr"),
        "labels_f1",
        "labels_irr",
        ((n_cat * cat_f1 + n_labels * F.col("labels_f1")) / (n_cat + n_labels)).alias("overall_f1"),
        ((n_cat * cat_irr + n_labels * F.col("labels_irr")) / (n_cat + n_labels)).alias("overall_irr"),
    )


def disagreements(aligned: DataFrame, labels: list[str], a: str, b: str) -> DataFrame:
    """Rows in which any label differs between two raters."""
    differs = [~F.col(f"{v}_{a}").eqNullSafe(F.col(f"{v}_{b}")) for v in labels]
    return aligned.filter(reduce(Column.__or__, differs))


def metrics_by_group(
    df: DataFrame, groups: dict[str, list | None], truth: str, predicted: str
) -> DataFrame:
    """F1, accuracy and sample size of a boolean label per group.

    A group column with listed levels spans the full grid: empty cells have n = 0 and null
    scores.
    """
    keys = list(groups)
    t, p = to_bool(F.col(truth)), to_bool(F.col(predicted))
    counts = df.na.drop(subset=keys).groupBy(*keys).agg(
        F.count_if(t & p).alias("_tp"),
        F.count_if(t).alias("_t"),
        F.count_if(p).alias("_p"),
        F.count_if(t == p).alias("_ok"),
        F.count("*").alias("n"),
    )
    leveled = [k for k in keys if groups[k] is not None]
    if leveled:
        free = [k for k in keys if k not in leveled]
        grid = counts.select(*free).distinct() if free else df.sparkSession.range(1).select()
        for k in leveled:
            grid = grid.withColumn(k, F.explode(F.array(*(F.lit(v) for v in groups[k]))))
        counts = grid.join(counts, keys, "left").na.fill(0)
    scores = _scores(F.col("_tp"), F.col("_p"), F.col("_t"))
    filled = F.col("n") > 0
    return counts.select(
        *keys,
        F.when(filled, scores["f1"]).alias("f1"),
        F.try_divide(F.col("_ok"), F.col("n")).alias("accuracy"),
        "n",
    )


def multilabel_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Subset accuracy, micro F1 and weighted scores of 0/1 label arrays."""
    subset = df.agg(F.avg((F.col(truth) == F.col(predicted)).cast("int"))).scalar()
    per_label = per_label_counts(df, truth, predicted)
    s = _scores(F.col("_tp"), F.col("_p"), F.col("_t"))
    weight = F.col("_t")
    micro = _scores(F.sum("_tp"), F.sum("_p"), F.sum("_t"))["f1"]
    return per_label.agg(
        micro.alias("micro_f1"),
        *((_ratio(F.sum(c * weight), F.sum(weight))).alias(f"weighted_{n}") for n, c in s.items()),
    ).withColumn("subset_accuracy", subset)


def per_label_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Hits, positives and accuracy per label position."""
    pairs = df.select(F.posexplode(F.arrays_zip(F.col(truth).alias("t"), F.col(predicted).alias("p"))))
    t, p = F.col("col.t") == 1, F.col("col.p") == 1
    return pairs.groupBy(F.col("pos").alias("label")).agg(
        F.count_if(t & p).alias("_tp"),
        F.count_if(t).alias("_t"),
        F.count_if(p).alias("_p"),
        F.avg((t == p).cast("int")).alias("accuracy"),
    )
