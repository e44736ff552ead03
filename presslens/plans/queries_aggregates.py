"""A: aggregations, shares, cross tables, bins and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import aggregates as G, attribution as A, bins as B
from presslens.plans.queries_joins import MAX_DAYS
from presslens.plans.registry import query
from presslens.plans.views import articles, breaches, rater_a, rater_b, table
from presslens.sources.storage import write_table

LABELS = ["False", "True", "yes"]


def is_breach():
    return F.col("label") != "False"



def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "a01_count_by",
    """SELECT publication, label, count(*) AS count FROM articles_v
       WHERE publication IS NOT NULL AND label IS NOT NULL GROUP BY ALL""",
    ("articles_v",),
)
def a01(spark, d):
    return G.count_by(articles(spark, d), ["publication", "label"])


@query(
    "a02_share_of_total",
    """SELECT publication, count, round(count / sum(count) OVER () * 100, 6) AS percentage
       FROM (SELECT publication, count(*) AS count FROM articles_v GROUP BY 1)""",
    ("articles_v",),
)
def a02(spark, d):
    counts = G.count_by(articles(spark, d), ["publication"])
    return rounded(G.share_of_total(counts, "count"), "percentage")


SHARES_SQL = """s AS (
    SELECT publication, count(*) AS count_all, count(*) FILTER (label <> 'False') AS count_breach
    FROM articles_v GROUP BY 1),
  p AS (SELECT publication, count_all, count_all / sum(count_all) OVER () * 100 AS percentage_all,
               count_breach, count_breach / sum(count_breach) OVER () * 100 AS percentage_breach
        FROM s)"""


def publication_shares(spark, d):
    rows = articles(spark, d).select("publication", "label")
    return G.compare_shares(rows, "publication", {"all": F.lit(True), "breach": is_breach()})


@query(
    "a03_compare_shares",
    f"""WITH {SHARES_SQL} SELECT publication, count_all, count_breach,
          round(percentage_all, 6) AS percentage_all, round(percentage_breach, 6) AS percentage_breach
        FROM p""",
    ("articles_v",),
)
def a03(spark, d):
    return rounded(publication_shares(spark, d), "percentage_all", "percentage_breach")


@query(
    "a03_compare_share_tables",
    """WITH c AS (SELECT n_name AS country, count(*) AS n FROM customer
                  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
            s AS (SELECT n_name AS country, count(*) AS n FROM supplier
                  JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
       SELECT coalesce(c.country, s.country) AS country, coalesce(c.n, 0) AS count_customers,
         round(coalesce(c.n / (SELECT sum(n) FROM c) * 100, 0), 6) AS percentage_customers,
         coalesce(s.n, 0) AS count_suppliers,
         round(coalesce(s.n / (SELECT sum(n) FROM s) * 100, 0), 6) AS percentage_suppliers
       FROM c FULL JOIN s ON c.country = s.country""",
)
def a03_tables(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    customer = table(spark, d, "customer")
    tables = {
        "customers": customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")),
        "suppliers": table(spark, d, "supplier").join(
            nation, F.col("s_nationkey") == F.col("n_nationkey")
        ),
    }
    shares = G.compare_share_tables(tables, "country")
    return rounded(shares, "percentage_customers", "percentage_suppliers")


@query(
    "a04_share_difference_top",
    f"""WITH {SHARES_SQL} SELECT publication,
          round(abs(percentage_breach - percentage_all), 6) AS difference FROM p
        ORDER BY abs(percentage_breach - percentage_all) DESC, publication LIMIT 15""",
    ("articles_v",),
)
def a04(spark, d):
    top = G.share_difference_top(
        publication_shares(spark, d), "publication", "percentage_breach", "percentage_all"
    )
    return rounded(top.select("publication", "difference"), "difference")


@query(
    "a05_event_summary",
    """SELECT org, arg_min(sector, article_id) AS sector, arg_min(mention, article_id) AS mention,
              count(headline) AS n_articles, count(DISTINCT headline) AS n_headlines,
              count(DISTINCT publication) AS n_publications FROM articles_v GROUP BY org""",
    ("articles_v",),
)
def a05(spark, d):
    return G.event_summary(
        articles(spark, d), ["org"], ["sector", "mention"], "article_id", "headline", "publication"
    )


@query(
    "a06_crosstab_with_total",
    """SELECT publication, count(*) FILTER (label = 'False') AS "False",
              count(*) FILTER (label = 'True') AS "True", count(*) FILTER (label = 'yes') AS yes,
              count(*) AS Total FROM articles_v GROUP BY 1""",
    ("articles_v",),
)
def a06(spark, d):
    return G.crosstab_with_total(articles(spark, d), "publication", "label", LABELS)


@query(
    "a07_conditional_sums",
    """SELECT user_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              count(*) AS all_items, count(*) FILTER (value > 30) AS high_items,
              count(*) FILTER (value <= 10) AS low_items FROM events GROUP BY 1, 2, 3""",
)
def a07(spark, d):
    events = table(spark, d, "events").select(
        "user_id", F.year("ts").alias("year"), F.month("ts").alias("month"), "value"
    )
    classes = {"high_items": F.col("value") > 30, "low_items": F.col("value") <= 10}
    return G.conditional_sums(events, ["user_id", "year", "month"], classes, "all_items")


COVERAGE_SQL = f"""SELECT b.breach_id, any_value(b.sector) AS sector,
         any_value(b.records) AS records, count(a.article_id) AS n_articles
       FROM breaches_v b LEFT JOIN articles_v a ON b.org = a.org
         AND b.breach_date < a.article_date
         AND date_diff('day', b.breach_date, a.article_date) < {MAX_DAYS} GROUP BY b.breach_id"""


def coverage(spark, d, keep_uncovered=True):
    a = articles(spark, d).select(F.col("org").alias("article_org"), "article_date")
    return A.coverage_per_event(
        breaches(spark, d), a, [("org", "article_org")], "breach_date", "article_date", MAX_DAYS,
        keep_uncovered=keep_uncovered,
    )


@query(
    "a08_avg_per_event",
    f"""SELECT sector, CAST(sum(n_articles) AS BIGINT) AS total_articles, count(*) AS n_events,
               round(sum(n_articles) / count(*), 6) AS articles_per_event
        FROM ({COVERAGE_SQL}) GROUP BY sector""",
    ("breaches_v", "articles_v"),
)
def a08(spark, d):
    averages = G.avg_per_event(coverage(spark, d), "sector", "n_articles", "breach_id")
    return rounded(averages, "articles_per_event")


@query(
    "a09_coverage_per_event",
    f"SELECT breach_id, n_articles FROM ({COVERAGE_SQL})",
    ("breaches_v", "articles_v"),
)
def a09(spark, d):
    return coverage(spark, d).select("breach_id", "n_articles")


@query(
    "a09_coverage_filter_after_join",
    f"""SELECT breach_id, n_articles FROM ({COVERAGE_SQL})
        WHERE n_articles > 0 OR breach_id NOT IN (
          SELECT breach_id FROM breaches_v b JOIN articles_v a ON b.org = a.org)""",
    ("breaches_v", "articles_v"),
)
def a09_filtered(spark, d):
    return coverage(spark, d, keep_uncovered=False).select("breach_id", "n_articles")


@query(
    "a10_lifetime",
    """SELECT user_id, min(ts) AS first_activity, max(ts) AS last_activity FROM events GROUP BY 1""",
)
def a10(spark, d):
    events = table(spark, d, "events").select(
        "user_id", F.col("ts").alias("first_activity"), F.col("ts").alias("last_activity")
    )
    return G.lifetime(events, ["user_id"], "first_activity", "last_activity")


TOTALS_SQL = """
    FROM (SELECT {0}, org, count(*) AS n, max(quantity) AS q FROM articles_v GROUP BY ALL)
    GROUP BY {0}"""


@query(
    "a11_two_level_totals",
    "SELECT publication, sum(q) AS records, CAST(sum(n) AS BIGINT) AS n_articles"
    + TOTALS_SQL.format("publication"),
    ("articles_v",),
)
def a11(spark, d):
    return G.two_level_totals(
        articles(spark, d), "publication", "org", "quantity", "records", "n_articles"
    )


@query(
    "a12_totals_raw_vs_distinct",
    "SELECT sector, sum(q) AS records, CAST(sum(n) AS BIGINT) AS n_articles"
    + TOTALS_SQL.format("sector"),
    ("articles_v",),
)
def a12(spark, d):
    return G.totals_raw_vs_distinct(
        articles(spark, d), "sector", "org", "quantity", "n_articles", "records"
    )


@query(
    "a13_dense_crosstab",
    """SELECT p_name, level AS p_size, count(p_partkey) AS count
       FROM (SELECT DISTINCT p_name FROM part)
       JOIN (SELECT unnest([1, 2, 3, 49, 50, 51]) AS level) ON true
       LEFT JOIN part USING (p_name) WHERE p_size = level GROUP BY ALL
       UNION ALL
       SELECT n.p_name, l.level, 0 FROM (SELECT DISTINCT p_name FROM part) n
       JOIN (SELECT unnest([1, 2, 3, 49, 50, 51]) AS level) l ON true
       WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_name = n.p_name AND p.p_size = l.level)""",
)
def a13(spark, d):
    part = table(spark, d, "part").select("p_name", "p_size")
    return G.dense_crosstab(part, "p_name", "p_size", [1, 2, 3, 49, 50, 51])


@query(
    "a14_yearly_counts",
    """SELECT year, publication, count, max(count) OVER (PARTITION BY publication) AS peak
       FROM (SELECT CAST(year(article_date) AS INTEGER) AS year, publication, count(*) AS count
             FROM articles_v GROUP BY ALL)""",
    ("articles_v",),
)
def a14(spark, d):
    rows = articles(spark, d).select(F.year("article_date").alias("year"), "publication")
    counts = G.count_by(rows, ["year", "publication"])
    peaks = counts.groupBy("publication").agg(F.max("count").alias("peak"))
    return counts.join(peaks, "publication").select("year", "publication", "count", "peak")


@query(
    "a15_describe",
    """SELECT c AS "column", count(x) AS count, round(avg(x), 4) AS mean,
              round(stddev_samp(x), 4) AS std, min(x) AS min, max(x) AS max,
              round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
              round(quantile_cont(x, 0.75), 6) AS q75
       FROM (SELECT 'l_quantity' AS c, l_quantity AS x FROM lineitem UNION ALL
             SELECT 'l_extendedprice', l_extendedprice FROM lineitem) GROUP BY c""",
)
def a15(spark, d):
    summary = G.describe(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    summary = rounded(summary, "mean", "std", digits=4)
    return rounded(summary, "q25", "q50", "q75")


@query(
    "a16_counts_for_categories",
    """SELECT source, category, (SELECT count(*) FROM part WHERE p_type = category
                AND (source = 'all' OR p_size > 25)) AS count
       FROM (VALUES ('all'), ('large')) s(source)
       JOIN (VALUES ('ECONOMY'), ('PROMO'), ('ABSENT')) c(category) ON true""",
)
def a16(spark, d):
    part = table(spark, d, "part").select("p_type", "p_size")
    tables = {"all": part, "large": part.filter("p_size > 25")}
    return G.counts_for_categories(tables, "p_type", ["ECONOMY", "PROMO", "ABSENT"])


QUARTILE_SQL = """q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q25,
    quantile_cont(o_totalprice, 0.5) AS q50, quantile_cont(o_totalprice, 0.75) AS q75
    FROM orders GROUP BY 1)"""


@query(
    "a17_iqr_outliers",
    f"""WITH {QUARTILE_SQL} SELECT o_orderkey, o_totalprice FROM orders JOIN q USING (o_orderstatus)
        WHERE o_totalprice < q25 - 0.5 * (q75 - q25) OR o_totalprice > q75 + 0.5 * (q75 - q25)""",
)
def a17(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    # The invented prices have no far tail, so the fences are drawn closer than 1.5.
    outliers = G.iqr_outliers(orders, "o_orderstatus", "o_totalprice", factor=0.5)
    return outliers.select("o_orderkey", "o_totalprice")


@query(
    "a17_box_numbers",
    f"""WITH {QUARTILE_SQL} SELECT o_orderstatus, round(any_value(q25), 6) AS q25,
          round(any_value(q50), 6) AS q50, round(any_value(q75), 6) AS q75,
          min(o_totalprice) FILTER (o_totalprice >= q25 - 1.5 * (q75 - q25)) AS whisker_low,
          max(o_totalprice) FILTER (o_totalprice <= q75 + 1.5 * (q75 - q25)) AS whisker_high,
          count(*) FILTER (o_totalprice < q25 - 1.5 * (q75 - q25)
                           OR o_totalprice > q75 + 1.5 * (q75 - q25)) AS n_outliers
        FROM orders JOIN q USING (o_orderstatus) GROUP BY 1""",
)
def a17_box(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_totalprice")
    return rounded(G.box_numbers(orders, "o_orderstatus", "o_totalprice"), "q25", "q50", "q75")


@query(
    "a18_group_order_by_stat",
    """SELECT p_brand, round(quantile_cont(p_retailprice, 0.5), 6) AS stat FROM part
       GROUP BY 1 ORDER BY stat DESC, p_brand""",
)
def a18(spark, d):
    part = table(spark, d, "part").select("p_brand", "p_retailprice")
    return rounded(G.group_order_by_stat(part, "p_brand", "p_retailprice"), "stat")


@query(
    "a19_rollup_small_to_other",
    f"""WITH {SHARES_SQL} SELECT CASE WHEN percentage_all < 4 THEN 'Other' ELSE publication END
          AS publication, CAST(sum(count_all) AS BIGINT) AS count_all,
          round(sum(percentage_all), 6) AS percentage_all,
          CAST(sum(count_breach) AS BIGINT) AS count_breach,
          round(sum(percentage_breach), 6) AS percentage_breach FROM p GROUP BY 1""",
    ("articles_v",),
)
def a19(spark, d):
    rolled = B.rollup_small_to_other(
        publication_shares(spark, d), "publication", "percentage_all", threshold=4
    )
    return rounded(rolled, "percentage_all", "percentage_breach")


@query(
    "a20_bin_fixed",
    """SELECT CAST(CAST(floor(c_acctbal / 5000) * 5000 AS BIGINT) AS VARCHAR) || '-' ||
              CAST(CAST(floor(c_acctbal / 5000) * 5000 AS BIGINT) + 4999 AS VARCHAR) AS bin,
              count(*) AS count FROM customer GROUP BY 1""",
)
def a20(spark, d):
    label = B.bin_fixed(F.col("c_acctbal"), 5000).alias("bin")
    return G.count_by(table(spark, d, "customer").select(label), ["bin"])


@query(
    "a20_bin_edges",
    """SELECT CAST(i AS INTEGER) AS bin_order, label AS bin,
         (SELECT count(*) FROM orders WHERE o_totalprice >= low AND o_totalprice < high) AS count
       FROM (VALUES (0, '1-500', 1, 500), (1, '501-5000', 500, 5000), (2, '5001-50000', 5000, 50000),
                    (3, '50001-200000', 50000, 200000), (4, '200000+', 200000, 1e18))
            t(i, label, low, high)""",
)
def a20_edges(spark, d):
    return B.count_bins(table(spark, d, "orders"), "o_totalprice", B.EMPLOYEE_EDGES, B.EMPLOYEE_LABELS)


@query(
    "a21_bin_quantile",
    """WITH c AS (SELECT quantile_cont(p_size, 1 / 3.0::DOUBLE) AS a,
                         quantile_cont(p_size, 2 / 3.0::DOUBLE) AS b FROM part)
       SELECT p_partkey, CASE WHEN p_size <= a THEN 'small' WHEN p_size <= b THEN 'medium'
                              ELSE 'large' END AS bin FROM part JOIN c ON true""",
)
def a21(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size")
    return B.bin_quantile(part, "p_size").select("p_partkey", "bin")


@query(
    "a22_histogram_density",
    """WITH x AS (SELECT least(floor(o_totalprice / 20000), 49) AS bin FROM orders
                  WHERE o_totalprice BETWEEN 0 AND 1000000),
            n AS (SELECT count(*) AS n FROM x)
       SELECT CAST(range AS INTEGER) AS bin, CAST(range * 20000 AS DOUBLE) AS bin_start,
              count(x.bin) AS count, round(count(x.bin) / (any_value(n) * 20000.0::DOUBLE), 15) AS density
       FROM range(50) LEFT JOIN x ON x.bin = range JOIN n ON true GROUP BY range""",
)
def a22(spark, d):
    orders = table(spark, d, "orders").select("o_totalprice")
    return rounded(B.histogram_density(orders, "o_totalprice", 50, 0.0, 1e6), "density", digits=15)


@query(
    "a23_distinct_counts",
    """SELECT publication, count(DISTINCT url) AS n_url, count(DISTINCT org) AS n_org
       FROM articles_v GROUP BY 1""",
    ("articles_v",),
)
def a23(spark, d):
    return G.distinct_counts(articles(spark, d), ["publication"], ["url", "org"])


@query(
    "a23_distinct_sketches",
    """SELECT publication, count(DISTINCT url) AS n_url, count(DISTINCT org) AS n_org,
              true AS url_close, true AS org_close FROM articles_v GROUP BY 1""",
    ("articles_v",),
)
def a23_sketches(spark, d):
    """Daily sketches, stored, merged per publication and held against the exact counts (five standard errors)."""
    columns = ["url", "org"]
    rows = articles(spark, d).select("publication", "article_date", *columns)
    daily = G.distinct_sketches(rows, ["publication", "article_date"], columns)
    stored = write_table(daily, "distinct-sketches")
    merged = G.sketched_counts(G.merge_sketches(stored, ["publication"], columns), columns)
    merged = merged.toDF("merged_publication", *(f"about_{c}" for c in columns))
    exact = G.distinct_counts(rows, ["publication"], columns)
    both = exact.join(merged, F.col("publication").eqNullSafe(F.col("merged_publication")))
    apart = 5 * 1.04 / 2**6
    return both.select(
        "publication",
        *(f"n_{c}" for c in columns),
        *(
            (F.abs(F.col(f"about_{c}") - F.col(f"n_{c}")) <= F.greatest(F.lit(1), F.col(f"n_{c}") * apart)).alias(f"{c}_close")
            for c in columns
        ),
    )


@query(
    "a23_dashboard",
    """SELECT method, sector, round(avg(records), 4) AS avg_records,
              round(sum(CAST(records AS DECIMAL(18, 2))), 2)::DOUBLE AS sum_records,
              count(*) AS n FROM breaches_v GROUP BY ALL""",
    ("breaches_v",),
)
def a23_dashboard(spark, d):
    return breaches(spark, d).groupBy("method", "sector").agg(
        F.round(F.avg("records"), 4).alias("avg_records"),
        F.sum(F.col("records").cast("decimal(18,2)")).cast("double").alias("sum_records"),
        F.count("*").alias("n"),
    )


@query(
    "a24_usage_totals",
    r"""SELECT records_processed, tokens_prompted, tokens_generated,
          round(tokens_prompted / 1000 * 0.005 + tokens_generated / 1000 * 0.015, 9) AS run_cost_usd
        FROM (SELECT count(*) AS records_processed,
          CAST(sum(len(regexp_extract_all(prompt, '\S+'))) AS BIGINT) AS tokens_prompted,
          CAST(sum(len(regexp_extract_all(reply, '\S+'))) AS BIGINT) AS tokens_generated
          FROM (SELECT CASE WHEN role = 'user' THEN text ELSE '' END AS prompt,
                       CASE WHEN role = 'assistant' THEN text ELSE '' END AS reply
                FROM conversations))""",
)
def a24(spark, d):
    text, role = F.col("text"), F.col("role")
    turns = table(spark, d, "conversations").select(
        F.when(role == "user", text).alias("prompt"), F.when(role == "assistant", text).alias("reply")
    )
    return rounded(G.usage_totals(turns, "prompt", "reply", 0.005, 0.015), "run_cost_usd", digits=9)


@query(
    "a25_pairwise_label_counts",
    """SELECT count(*) FILTER (a.quality = b.quality) AS n_equal,
              count(*) FILTER (a.quality <> b.quality) AS n_different,
              count(*) FILTER (a.quality AND NOT b.quality) AS n_only_a,
              count(*) FILTER (NOT a.quality AND b.quality) AS n_only_b
       FROM rater_a a JOIN rater_b b USING (doc_id)""",
    ("rater_a", "rater_b"),
)
def a25(spark, d):
    a = rater_a(spark, d).select("doc_id", F.col("quality").alias("a"))
    b = rater_b(spark, d).select("doc_id", F.col("quality").alias("b"))
    return G.pairwise_label_counts(a.join(b, "doc_id"), "a", "b")
