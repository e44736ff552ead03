"""T: tests, regression, intervals and density estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import bootstrap as B, stats as S
from presslens.operators.bins import rollup_small_to_other
from presslens.plans.queries_aggregates import SHARES_SQL, publication_shares, rounded
from presslens.plans.registry import query
from presslens.plans.views import articles, table

GRID = [float(x) for x in range(0, 500_001, 50_000)]
GRID_SQL = "(SELECT unnest(range(0, 500001, 50000))::DOUBLE AS grid)"

Z_SQL = f"""{SHARES_SQL},
  r AS (SELECT CASE WHEN percentage_all < 4 THEN 'Other' ELSE publication END AS publication,
               sum(percentage_all) AS pa, sum(percentage_breach) AS pb, sum(count_breach) AS n
        FROM p GROUP BY 1),
  z AS (SELECT publication, sqrt(pa / 100 * (1 - pa / 100) / (SELECT sum(n) FROM r)) AS se, pa, pb
        FROM r),
  zz AS (SELECT publication, se, (pb - pa) / 100 / se AS z FROM z)"""


def _rolled(spark, d):
    return rollup_small_to_other(
        publication_shares(spark, d), "publication", "percentage_all", threshold=4
    )


@query(
    "t01_z_test_shares",
    f"""WITH {Z_SQL} SELECT publication, round(se, 9) AS standard_error, round(z, 6) AS z_score
        FROM zz""",
    ("articles_v",),
)
def t01(spark, d):
    tested = S.z_test_shares(
        _rolled(spark, d), "percentage_breach", "percentage_all", "count_breach", with_p=False
    )
    return tested.select(
        "publication", F.round("standard_error", 9).alias("standard_error"),
        F.round("z_score", 6).alias("z_score"),
    )


# The tail is integrated by Simpson's rule over [|z|, |z| + 12].
@query(
    "t01_z_test_p_values",
    f"""WITH {Z_SQL} SELECT publication, round(p, 6) AS p_value, p < 0.05 AS significant FROM (
          SELECT publication, 2 / sqrt(2 * pi()) * 12 / 6000.0::DOUBLE / 3 * sum(
            CASE WHEN i IN (0, 6000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp(-pow(abs(z) + i * 12 / 6000.0::DOUBLE, 2) / 2)) AS p
          FROM zz JOIN range(6001) t(i) ON true GROUP BY publication)""",
    ("articles_v",),
)
def t01_p(spark, d):
    tested = S.z_test_shares(
        _rolled(spark, d), "percentage_breach", "percentage_all", "count_breach"
    )
    return tested.select("publication", F.round("p_value", 6).alias("p_value"), "significant")


@query(
    "t02_chi_square_gof",
    f"""WITH {SHARES_SQL}, e AS (
          SELECT count_breach AS o, count_all * (SELECT sum(count_breach) FROM p)
                                    / (SELECT sum(count_all) FROM p) AS e FROM p)
        SELECT round(sum(pow(o - e, 2) / e), 6) AS statistic, count(*) - 1 AS df FROM e""",
    ("articles_v",),
)
def t02(spark, d):
    fit = S.chi_square_gof(publication_shares(spark, d), "count_breach", "count_all", with_p=False)
    return rounded(fit, "statistic")


# The density is integrated by Simpson's rule, the gamma function is DuckDB's.
@query(
    "t02_chi_square_p_value",
    f"""WITH {SHARES_SQL}, e AS (
          SELECT count_breach AS o, count_all * (SELECT sum(count_breach) FROM p)
                                    / (SELECT sum(count_all) FROM p) AS e FROM p),
        fit AS (SELECT sum(pow(o - e, 2) / e) AS x, (count(*) - 1) / 2 AS a FROM e)
        SELECT round(sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp((a - 1) * ln(x + i * 0.02::DOUBLE) - (x + i * 0.02::DOUBLE) / 2
                  - a * ln(2) - lgamma(a))) * 0.02::DOUBLE / 3, 6) AS p_value
        FROM fit JOIN range(20001) t(i) ON true""",
    ("articles_v",),
)
def t02_p(spark, d):
    fit = S.chi_square_gof(publication_shares(spark, d), "count_breach", "count_all")
    return fit.select(F.round("p_value", 6).alias("p_value"))


@query(
    "t03_complement_shares",
    f"""WITH {SHARES_SQL} SELECT publication, count_all - count_breach AS count_rest,
          round((count_all - count_breach) / sum(count_all - count_breach) OVER () * 100, 6)
            AS percentage_rest FROM p""",
    ("articles_v",),
)
def t03(spark, d):
    rest = S.complement_shares(publication_shares(spark, d), "count_all", "count_breach")
    return rounded(rest.select("publication", "count_rest", "percentage_rest"), "percentage_rest")


@query(
    "t04_wald_ci",
    f"""WITH {SHARES_SQL} SELECT publication, round(1.96 * sqrt(
          percentage_breach / 100 * (1 - percentage_breach / 100) / count_breach) * 100, 6) AS margin
        FROM p""",
    ("articles_v",),
)
def t04(spark, d):
    margin = S.wald_margin(F.col("percentage_breach"), F.col("count_breach"))
    return publication_shares(spark, d).select("publication", F.round(margin, 6).alias("margin"))


REGRESSION_SQL = """SELECT count(*) AS n, round(corr(l_extendedprice, l_quantity), 9) AS r,
    round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
    round(regr_r2(l_extendedprice, l_quantity), 9) AS r2,
    round(sqrt((1 - regr_r2(l_extendedprice, l_quantity)) * regr_syy(l_extendedprice, l_quantity)
               / regr_sxx(l_extendedprice, l_quantity) / (count(*) - 2)), 5) AS stderr
    FROM lineitem"""


def _regression(df):
    return df.select(
        "n", F.round("r", 9).alias("r"), F.round("slope", 4).alias("slope"),
        F.round("intercept", 3).alias("intercept"), F.round("r2", 9).alias("r2"),
        F.round("stderr", 5).alias("stderr"),
    )


@query("t05_correlate_regress", REGRESSION_SQL)
def t05(spark, d):
    items = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    return _regression(S.correlate_regress(items, "l_quantity", "l_extendedprice", with_p=False))


# One minus the density integrated over [-|t|, |t|] by Simpson's rule.
@query(
    "t05_regression_p_value",
    """WITH f AS (SELECT p_brand, count(*) AS n, regr_slope(p_retailprice, p_size) AS b,
            sqrt((1 - regr_r2(p_retailprice, p_size)) * regr_syy(p_retailprice, p_size)
                 / regr_sxx(p_retailprice, p_size) / (count(*) - 2)) AS se FROM part GROUP BY 1),
          g AS (SELECT p_brand, abs(b / se) AS t, (n - 2)::DOUBLE AS v FROM f)
       SELECT p_brand, round(1 - 2 * t / 2000.0::DOUBLE / 3 * sum(
           CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
           * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())
           * pow(1 + pow(t * i / 2000.0::DOUBLE, 2) / v, -(v + 1) / 2)), 6) AS p_value
       FROM g JOIN range(2001) r(i) ON true GROUP BY p_brand, t, v""",
)
def t05_p(spark, d):
    items = table(spark, d, "part").select("p_brand", "p_size", "p_retailprice")
    fit = S.correlate_regress(items, "p_size", "p_retailprice", ["p_brand"])
    return fit.select("p_brand", F.round("p_value", 6).alias("p_value"))


@query("t06_correlate_filtered", REGRESSION_SQL + " WHERE l_returnflag <> 'N'")
def t06(spark, d):
    items = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice", "l_returnflag")
    fit = S.correlate_filtered(
        items, "l_quantity", "l_extendedprice", "l_returnflag", ["N"], with_p=False
    )
    return _regression(fit)


@query("t07_bootstrap_share_ci")
def t07(spark, d):
    return B.bootstrap_share_ci(articles(spark, d).select("publication"), "publication", n=1000)


def _replicates_sql(rows: str, key: str, n: int, frac: float, seed: int = 42) -> str:
    """`drawn`: the rows of `rows` with every replicate and how often it draws them."""
    steps = ", ".join(repr(float(s)) for s in B._poisson_steps(frac) if s < 1)
    wrap = 1 << 64
    mixed = f"(({key}::UHUGEINT + (r + 1)::UHUGEINT * {0x9E3779B97F4A7C15}) % {wrap})::UBIGINT"
    words = [f"h0 AS (SELECT *, {mixed} AS z FROM keyed, range({n}) t(r))"]
    for i, (shift, factor) in enumerate(((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))):
        step = f"((xor(z, z >> {shift}))::UHUGEINT * {factor} % {wrap})::UBIGINT"
        words.append(f"h{i + 1} AS (SELECT * REPLACE ({step} AS z) FROM h{i})")
    return f"""keyed AS ({rows}), {", ".join(words)},
        drawn AS (SELECT *, len(list_filter([{steps}], lambda s: s <= u)) AS w FROM (
            SELECT *, (xor(z, z >> 31) >> 11)::DOUBLE / 9007199254740992 AS u FROM h2))"""


def _key_sql(column: str) -> str:
    return f"('0x' || substr(md5({column} || '|42'), 1, 15))::UBIGINT"


def _interval_sql(value: str) -> str:
    return f"round(quantile_cont({value}, 0.025), 6) AS low, round(quantile_cont({value}, 0.975), 6) AS high"


@query(
    "t07_bootstrap_mean_ci",
    f"""WITH {_replicates_sql(f"SELECT o_orderpriority, o_totalprice AS x, {_key_sql('o_orderkey')} AS key FROM orders", "key", 200, 0.2)},
        m AS (SELECT o_orderpriority, r, sum(w * x) / sum(w) AS v FROM drawn GROUP BY ALL HAVING sum(w) > 0)
        SELECT o_orderpriority, {_interval_sql("v")}, count(*) AS n_replicates FROM m GROUP BY ALL""",
)
def t07_mean(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    found = B.bootstrap_mean_ci(
        orders, ["o_orderkey"], "o_totalprice", ["o_orderpriority"], n=200, frac=0.2
    )
    return rounded(found, "low", "high", digits=6)


@query(
    "t07_bootstrap_regression",
    f"""WITH {_replicates_sql(f"SELECT p_brand, p_size AS x, p_retailprice AS y, {_key_sql('p_partkey')} AS key FROM part", "key", 50, 1.0)},
        m AS (SELECT p_brand, r, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * y) AS sxy,
                     sum(w * x * x) AS sxx, sum(w * y * y) AS syy FROM drawn GROUP BY ALL),
        s AS (SELECT p_brand, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS slope,
                     (n * sxy - sx * sy) / nullif(sqrt(greatest(n * sxx - sx * sx, 0) * greatest(n * syy - sy * sy, 0)), 0) AS r
              FROM m)
        SELECT p_brand, 'slope' AS statistic, {_interval_sql("slope")}, count(slope) AS n_replicates FROM s GROUP BY ALL
        UNION ALL SELECT p_brand, 'r', {_interval_sql("r")}, count(r) FROM s GROUP BY ALL""",
)
def t07_regression(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    moments = B.regression_moments(F.col("p_size"), F.col("p_retailprice"))
    stats = {"slope": B.slope(), "r": B.correlation()}
    found = B.bootstrap_statistics_ci(part, ["p_partkey"], moments, stats, ["p_brand"], n=50)
    return rounded(found, "low", "high", digits=6)


@query(
    "t07_bootstrap_rates",
    f"""WITH {_replicates_sql(f"SELECT quality = 1 AS t, n_chars >= 500 AS p, {_key_sql('doc_id')} AS key FROM labels JOIN documents USING (doc_id)", "key", 100, 1.0)},
        m AS (SELECT r, sum(CASE WHEN t AND p THEN w ELSE 0 END) AS tp, sum(CASE WHEN NOT t AND p THEN w ELSE 0 END) AS fp,
                     sum(CASE WHEN t AND NOT p THEN w ELSE 0 END) AS fn FROM drawn GROUP BY r),
        s AS (SELECT 'precision' AS statistic, tp / nullif(tp + fp, 0) AS v FROM m
              UNION ALL SELECT 'recall', tp / nullif(tp + fn, 0) FROM m
              UNION ALL SELECT 'f1', 2 * tp / nullif(2 * tp + fp + fn, 0) FROM m)
        SELECT statistic, {_interval_sql("v")}, count(v) AS n_replicates FROM s GROUP BY statistic""",
)
def t07_rates(spark, d):
    """How well length tells the quality label of a document."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    rows = table(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id")
    moments = B.confusion_moments(F.col("quality") == 1, F.col("n_chars") >= 500)
    stats = {"precision": B.precision(), "recall": B.recall(), "f1": B.f1()}
    found = B.bootstrap_statistics_ci(rows, ["doc_id"], moments, stats, n=100)
    return rounded(found, "low", "high", digits=6)


@query(
    "t11_resampled_band",
    f"""WITH {_replicates_sql(f"SELECT p_size AS x, p_retailprice AS y, {_key_sql('p_partkey')} AS key FROM part", "key", 100, 1.0)},
        m AS (SELECT r, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * y) AS sxy,
                     sum(w * x * x) AS sxx FROM drawn GROUP BY r),
        f AS (SELECT unnest([0.0, 10.0, 25.0, 50.0])::DOUBLE AS grid, sy / n AS my, sx / n AS mx,
                     (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b FROM m)
        SELECT grid, {_interval_sql("my + b * (grid - mx)")}, count(*) AS n_replicates FROM f GROUP BY grid""",
)
def t11_resampled(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    band = B.resampled_band(part, ["p_partkey"], "p_size", "p_retailprice", [0.0, 10.0, 25.0, 50.0], n=100)
    return rounded(band, "low", "high", digits=6)


@query(
    "t08_ci_gap",
    """WITH m AS (SELECT p_type, p_size > 25 AS big, avg(p_retailprice) AS m,
                         stddev_samp(p_retailprice) / sqrt(count(*)) AS e FROM part GROUP BY ALL),
            j AS (SELECT p_type, a.m - 0.1 * a.e AS la, a.m + 0.1 * a.e AS ha,
                         b.m - 0.1 * b.e AS lb, b.m + 0.1 * b.e AS hb
                  FROM m a JOIN m b USING (p_type) WHERE a.big AND NOT b.big)
       SELECT p_type, round(CASE WHEN hb < la THEN la - hb WHEN ha < lb THEN lb - ha
                ELSE abs((la + ha) / 2 - (lb + hb) / 2) * 1e-20 END, 6) AS max_diff,
              round((la + ha) / 2, 6) AS rate_a, round(ha - la, 6) AS error_a FROM j""",
)
def t08(spark, d):
    part = table(spark, d, "part").select("p_type", "p_size", "p_retailprice")

    def interval(rows):
        mean, error = F.avg("p_retailprice"), F.stddev_samp("p_retailprice") / F.sqrt(F.count("*"))
        return rows.groupBy("p_type").agg(
            (mean - 0.1 * error).alias("low"), (mean + 0.1 * error).alias("high")
        )

    gaps = S.compare_intervals(
        interval(part.filter("p_size > 25")), interval(part.filter("p_size <= 25")), "p_type"
    )
    return rounded(gaps.select("p_type", "max_diff", "rate_a", "error_a"), "max_diff", "rate_a", "error_a")


@query(
    "t09_kde",
    f"""WITH s AS (SELECT o_orderstatus, count(*) AS n,
                          stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h
                   FROM orders GROUP BY 1)
        SELECT o_orderstatus, grid,
               round(sum(exp(-pow((grid - o_totalprice) / h, 2) / 2))
                     / any_value(n * h * sqrt(2 * pi())), 15) AS density
        FROM orders JOIN s USING (o_orderstatus) JOIN {GRID_SQL} ON true GROUP BY ALL""",
)
def t09(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_totalprice")
    return rounded(S.kde(orders, "o_totalprice", GRID, ["o_orderstatus"]), "density", digits=15)


@query(
    "t09_kde_bandwidth",
    f"""WITH s AS (SELECT count(*) AS n, stddev_samp(o_totalprice) * 0.6 AS h FROM orders)
        SELECT grid, round(sum(exp(-pow((grid - o_totalprice) / h, 2) / 2))
                           / any_value(n * h * sqrt(2 * pi())), 15) AS density
        FROM orders JOIN s ON true JOIN {GRID_SQL} ON true GROUP BY ALL""",
)
def t09_bandwidth(spark, d):
    orders = table(spark, d, "orders").select("o_totalprice")
    estimate = S.kde(orders, "o_totalprice", GRID, bandwidth_factor=0.6)
    return rounded(estimate, "density", digits=15)


@query(
    "t10_normality_check",
    """WITH m AS (SELECT count(*) AS n, avg(value) AS mean FROM events),
            c AS (SELECT any_value(n) AS n, avg(pow(value - mean, 2)) AS m2,
                         avg(pow(value - mean, 3)) AS m3, avg(pow(value - mean, 4)) AS m4
                  FROM events JOIN m ON true)
       SELECT n, round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / pow(m2, 2) - 3, 6) AS kurtosis,
              round(n / 6 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / pow(m2, 2) - 3, 2) / 4), 3)
                AS statistic FROM c""",
)
def t10(spark, d):
    check = S.normality_check(table(spark, d, "events").select("value"), "value", with_p=False)
    return rounded(rounded(check, "skewness", "kurtosis"), "statistic", digits=3)


@query(
    "t11_regression_band",
    """WITH f AS (SELECT count(*) AS n, regr_slope(p_retailprice, p_size) AS b,
            regr_intercept(p_retailprice, p_size) AS a, regr_r2(p_retailprice, p_size) AS r2,
            regr_sxx(p_retailprice, p_size) AS sxx, regr_syy(p_retailprice, p_size) AS syy,
            regr_avgx(p_retailprice, p_size) AS mx FROM part),
          g AS (SELECT *, unnest([0.0, 10.0, 25.0, 50.0])::DOUBLE AS grid FROM f),
          h AS (SELECT grid, a + b * grid AS fit, sqrt((1 - r2) * syy / (n - 2)
                       * (1 / n + pow(grid - mx, 2) / sxx)) AS se FROM g)
       SELECT grid, round(fit, 5) AS fit, round(fit - 1.96 * se, 5) AS low,
              round(fit + 1.96 * se, 5) AS high FROM h""",
)
def t11(spark, d):
    part = table(spark, d, "part").select("p_size", "p_retailprice")
    band = S.regression_band(part, "p_size", "p_retailprice", [0.0, 10.0, 25.0, 50.0])
    return rounded(band, "fit", "low", "high", digits=5)
