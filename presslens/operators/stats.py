"""Tests, regression and density estimates over aggregated tables or in one pass."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.tails import chi_square_p_value, normal_p_value, student_p_value


def z_test_shares(
    shares: DataFrame,
    observed_pct: str,
    expected_pct: str,
    observed_count: str,
    alpha: float = 0.05,
    with_p: bool = True,
) -> DataFrame:
    """Per category: standard error of the expected share, z score, two-sided p."""
    total = shares.agg(F.sum(observed_count)).scalar()
    expected = F.col(expected_pct) / 100
    observed = F.col(observed_pct) / 100
    out = shares.withColumn("standard_error", F.sqrt(F.try_divide(expected * (1 - expected), total)))
    out = out.withColumn(
        "z_score", F.try_divide(observed - expected, F.col("standard_error"))
    )
    if not with_p:
        return out
    out = out.withColumn("p_value", normal_p_value(F.col("z_score")))
    return out.withColumn("significant", F.col("p_value") < alpha)


def chi_square_gof(
    shares: DataFrame,
    observed: str,
    expected_weight: str,
    rescale: bool = True,
    with_p: bool = True,
) -> DataFrame:
    """Goodness of fit of observed counts to expected weights: statistic, df, p.

    Weights are scaled to the observed total; with rescale=False differing totals raise
    inside the job. A category without weight adds nothing if nothing was observed, else the
    statistic is infinite and p is 0. Without any weight the statistic is null.
    """
    sums = shares.agg(F.sum(observed).alias("o"), F.sum(expected_weight).alias("e"))
    total_o = sums.select("o").scalar()
    total_e = sums.select("e").scalar()
    weight = F.col(expected_weight).cast("double")
    if rescale:
        expected = F.try_divide(weight * total_o, total_e)
    else:
        equal = F.abs(total_o - total_e) <= F.abs(total_e) * 1e-8
        expected = F.when(equal, weight).otherwise(
            F.raise_error(F.lit("observed and expected totals differ"))
        )
    diff = F.col(observed) - expected
    weightless = F.when(diff == 0, 0.0).otherwise(float("inf"))
    term = F.when(expected == 0, weightless).otherwise(F.try_divide(diff * diff, expected))
    out = shares.agg(F.sum(term).alias("statistic"), (F.count("*") - 1).alias("df"))
    if not with_p:
        return out
    finite = F.when(F.col("statistic") < float("inf"), F.col("statistic"))
    p_value = F.when(F.col("statistic") == float("inf"), 0.0).otherwise(
        chi_square_p_value(finite, F.col("df"))
    )
    return out.withColumn("p_value", p_value)


def complement_shares(
    shares: DataFrame, all_count: str, part_count: str, out: str = "rest"
) -> DataFrame:
    """all - part per category and its share of the summed difference (null if that is 0)."""
    rest = shares.withColumn(f"count_{out}", F.col(all_count) - F.col(part_count))
    total = rest.agg(F.sum(f"count_{out}")).scalar()
    return rest.withColumn(f"percentage_{out}", F.try_divide(F.col(f"count_{out}"), total) * 100)


def wald_margin(percentage: Column, n: Column, z: float = 1.96) -> Column:
    """Half width of the interval of a percentage with n observations, in points; null if n is 0."""
    p = percentage / 100
    return z * F.sqrt(F.try_divide(p * (1 - p), n)) * 100


def correlate_regress(
    df: DataFrame, x: str, y: str, groups: list[str] | None = None, with_p: bool = True
) -> DataFrame:
    """Pearson r, slope, intercept, r squared, slope standard error and p in one pass.

    A constant x or fewer than three points give a null standard error and p; points on a
    sloping line give p 0.
    """
    yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
    out = df.groupBy(*(groups or [])).agg(
        F.regr_count(yc, xc).alias("n"),
        F.regr_sxy(yc, xc).alias("_sxy"),
        F.regr_slope(yc, xc).alias("slope"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.regr_r2(yc, xc).alias("r2"),
        F.regr_sxx(yc, xc).alias("_sxx"),
        F.regr_syy(yc, xc).alias("_syy"),
    )
    df_resid = F.col("n") - 2
    unexplained = F.greatest(1 - F.col("r2"), F.lit(0.0)) * F.col("_syy")
    variance = F.try_divide(F.try_divide(unexplained, F.col("_sxx")), df_resid)
    # corr() itself fails on a constant column.
    r = F.try_divide(F.col("_sxy"), F.sqrt(F.col("_sxx") * F.col("_syy")))
    measures = [r.alias("r"), "slope", "intercept", "r2", F.sqrt(variance).alias("stderr")]
    out = out.select(*(groups or []), "n", *measures)
    if not with_p:
        return out
    exact = (F.col("stderr") == 0) & (F.col("slope") != 0)
    p_value = student_p_value(F.try_divide(F.col("slope"), F.col("stderr")), df_resid)
    return out.withColumn("p_value", F.when(exact, 0.0).otherwise(p_value))


def correlate_filtered(
    df: DataFrame, x: str, y: str, id_col: str, excluded: list, with_p: bool = True
) -> DataFrame:
    """correlate_regress without the listed outliers."""
    kept = df.filter(F.coalesce(~F.col(id_col).isin(*excluded), F.lit(True)))
    return correlate_regress(kept, x, y, with_p=with_p)


def ci_gap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """Distance of two intervals; overlapping ones get a vanishing mean difference."""
    means = F.abs((low_a + high_a) / 2 - (low_b + high_b) / 2)
    return (
        F.when(high_b < low_a, low_a - high_b)
        .when(high_a < low_b, low_b - high_a)
        .otherwise(means * 1e-20)
    )


def compare_intervals(
    a: DataFrame, b: DataFrame, key: str, n: int | None = 15
) -> DataFrame:
    """Join two (key, low, high) tables; rate, error and gap, widest gaps first."""
    left = a.select(key, F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    right = b.select(key, F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    cols = [F.col(c) for c in ("low_a", "high_a", "low_b", "high_b")]
    out = left.join(right, key).select(
        key,
        *cols,
        ((cols[0] + cols[1]) / 2).alias("rate_a"),
        ((cols[2] + cols[3]) / 2).alias("rate_b"),
        (cols[1] - cols[0]).alias("error_a"),
        (cols[3] - cols[2]).alias("error_b"),
        ci_gap(*cols).alias("max_diff"),
    )
    out = out.orderBy(F.desc("max_diff"), key)
    return out if n is None else out.limit(n)


def kde(
    df: DataFrame,
    x: str,
    grid: list[float],
    groups: list[str] | None = None,
    bandwidth_factor: float | None = None,
) -> DataFrame:
    """Gaussian kernel density on a fixed grid; factor n^(-1/5) unless given.

    A constant sample or a single value has no bandwidth and gets null densities.

    The grid is a constant array inside one aggregate: partial sums per grid point are
    combined map-side, no row is repeated.
    """
    groups = groups or []
    rows = df.select(*groups, F.col(x).cast("double").alias("_x")).na.drop()
    spread = rows.groupBy(*groups).agg(
        F.count("*").alias("_n"), F.stddev_samp("_x").alias("_s")
    )
    factor = F.lit(bandwidth_factor) if bandwidth_factor else F.pow(F.col("_n"), F.lit(-0.2))
    spread = spread.withColumn("_h", factor * F.col("_s"))
    if groups:
        joined = rows.join(spread, groups)
    else:
        joined = rows.withColumns(
            {"_n": spread.select("_n").scalar(), "_h": spread.select("_h").scalar()}
        )

    def kernel(point: float) -> Column:
        z = F.try_divide(F.lit(float(point)) - F.col("_x"), F.col("_h"))
        return F.exp(-z * z / 2)

    sums = joined.groupBy(*groups, "_n", "_h").agg(
        *(F.sum(kernel(p)).alias(f"_g{i}") for i, p in enumerate(grid))
    )
    cells = F.array(
        *(
            F.struct(F.lit(float(p)).alias("grid"), F.col(f"_g{i}").alias("_sum"))
            for i, p in enumerate(grid)
        )
    )
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return sums.select(*groups, scale.alias("_scale"), F.inline(cells)).select(
        *groups, "grid", F.try_divide("_sum", "_scale").alias("density")
    )


def normality_check(df: DataFrame, x: str, with_p: bool = True) -> DataFrame:
    """Jarque-Bera statistic from skewness and excess kurtosis, one pass."""
    out = df.agg(
        F.count(x).alias("n"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis")
    )
    jb = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow("kurtosis", F.lit(2)) / 4)
    out = out.withColumn("statistic", jb)
    return out.withColumn("p_value", chi_square_p_value(F.col("statistic"), F.lit(2))) if with_p else out


def regression_band(
    df: DataFrame, x: str, y: str, grid: list[float], z: float = 1.96
) -> DataFrame:
    """Fitted line and its confidence band at grid points, from one pass of sums.

    The band is null for fewer than three points or a constant x.
    """
    yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
    fit = df.agg(
        F.regr_count(yc, xc).alias("n"),
        F.regr_slope(yc, xc).alias("b"),
        F.regr_intercept(yc, xc).alias("a"),
        F.regr_r2(yc, xc).alias("r2"),
        F.regr_sxx(yc, xc).alias("sxx"),
        F.regr_syy(yc, xc).alias("syy"),
        F.regr_avgx(yc, xc).alias("mx"),
    )
    at = F.explode(F.array(*(F.lit(float(g)) for g in grid)))
    fit = fit.withColumn("grid", at)
    s2 = F.try_divide(F.greatest(1 - F.col("r2"), F.lit(0.0)) * F.col("syy"), F.col("n") - 2)
    off = F.col("grid") - F.col("mx")
    se = F.sqrt(s2 * (F.try_divide(F.lit(1), F.col("n")) + F.try_divide(off * off, F.col("sxx"))))
    line = F.col("a") + F.col("b") * F.col("grid")
    return fit.select(
        "grid", line.alias("fit"), (line - z * se).alias("low"), (line + z * se).alias("high")
    )
