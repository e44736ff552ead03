"""J: joins, attribution and alignment; U: set operations and reshaping; G02."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import attribution as A, joins as J, reshape as U
from presslens.operators.aggregates import count_by
from presslens.operators.fuzzy import join_fuzzy
from presslens.operators.synthetic import (
    orphan_keys,
    synthetic_articles,
    synthetic_corporations,
    synthetic_events,
)
from presslens.plans.registry import query
from presslens.plans.views import (
    articles,
    breaches,
    companies,
    headlines,
    product_mentions,
    products,
    rater_a,
    rater_b,
    table,
)

MAX_DAYS = 89  # fixed value: the smallest gap of 90 days less one


@query(
    "j01_join_ci_exact",
    """SELECT article_id, company_id, name FROM articles_v
       JOIN companies_v ON lower(mention) = lower(name)""",
    ("articles_v", "companies_v"),
)
def j01(spark, d):
    joined = J.join_ci_exact(articles(spark, d), companies(spark, d), "mention", "name")
    return joined.select("article_id", "company_id", "name")


@query(
    "j02_join_normalised",
    """SELECT breach_id, company_id, name FROM breaches_v
       JOIN companies_v ON regexp_replace(lower(organisation), '[^a-z0-9]', '', 'g')
                         = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')""",
    ("breaches_v", "companies_v"),
)
def j02(spark, d):
    joined = J.join_normalised(breaches(spark, d), companies(spark, d), "organisation", "name")
    return joined.select("breach_id", "company_id", "name")


@query(
    "j03_left_join_normalised",
    """SELECT company_id, name, breach_id FROM (
         SELECT company_id, name FROM companies_v UNION ALL SELECT s_suppkey, s_name FROM supplier)
       LEFT JOIN breaches_v
       ON regexp_replace(lower(name), '[^a-z0-9]', '', 'g')
        = regexp_replace(lower(organisation), '[^a-z0-9]', '', 'g')""",
    ("breaches_v", "companies_v"),
)
def j03(spark, d):
    """All companies and suppliers, of which the latter have no breach."""
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("name"))
    known = companies(spark, d).select("company_id", "name").unionByName(suppliers)
    joined = J.left_join_normalised(known, breaches(spark, d), "name", "organisation")
    return joined.select("company_id", "name", "breach_id")


@query(
    "j04_join_ambiguous_names",
    """SELECT article_id, product_id, name FROM product_mentions_v
       JOIN (SELECT * FROM products_v WHERE name IN (
               SELECT name FROM products_v GROUP BY name HAVING count(*) > 1))
       ON lower(full_mention) = lower(name)""",
    ("product_mentions_v", "products_v"),
)
def j04(spark, d):
    joined = J.join_ambiguous_names(
        product_mentions(spark, d), products(spark, d), "full_mention", "name"
    )
    return joined.select("article_id", "product_id", "name")


@query(
    "j05_join_name_prefix",
    """WITH n AS (SELECT product_id, size, regexp_replace(lower(name), '[^a-z0-9 ]', '', 'g') AS k
                  FROM products_v),
            m AS (SELECT DISTINCT mention,
                         regexp_replace(lower(mention), '[^a-z0-9 ]', '', 'g') AS k
                  FROM product_mentions_v),
            best AS (SELECT mention, arg_max(product_id, (size, -product_id)) AS product_id
                     FROM m JOIN n ON starts_with(n.k, m.k || ' ') GROUP BY mention)
       SELECT article_id, product_id FROM product_mentions_v JOIN best USING (mention)""",
    ("product_mentions_v", "products_v"),
)
def j05(spark, d):
    joined = J.join_name_prefix(
        product_mentions(spark, d), products(spark, d), "mention", "name", "size", ["product_id"]
    )
    return joined.select("article_id", "product_id")


def _domains(spark, d):
    return headlines(spark, d).groupBy(F.col("domain").alias("site")).agg(
        F.count("*").alias("size")
    )


@query(
    "j06_join_domain_prefix",
    """WITH sites AS (SELECT domain AS site, count(*) AS size FROM headlines_v GROUP BY 1),
            m AS (SELECT page_id, upper(split_part(domain, '.', 1)) AS mention FROM headlines_v)
       SELECT page_id, site FROM (
         SELECT page_id, site, row_number() OVER (PARTITION BY page_id
                                                  ORDER BY size DESC, site) AS rn
         FROM m JOIN sites ON starts_with(
           site, regexp_replace(lower(mention), '[^a-z0-9]', '', 'g') || '.'))
       WHERE rn = 1""",
    ("headlines_v",),
)
def j06(spark, d):
    mention = F.upper(F.substring_index("domain", ".", 1)).alias("mention")
    pages = headlines(spark, d).select("page_id", mention)
    joined = J.join_domain_prefix(pages, _domains(spark, d), "mention", "site", "size", ["site"])
    return joined.select("page_id", "site")


@query(
    "j07_min_event_gap",
    """SELECT CAST(min(gap) AS INTEGER) AS min_gap_days FROM (
         SELECT date_diff('day', lag(breach_date) OVER (PARTITION BY org ORDER BY breach_date),
                          breach_date) AS gap
         FROM (SELECT DISTINCT org, breach_date FROM breaches_v))""",
    ("breaches_v",),
)
def j07(spark, d):
    return A.min_event_gap(breaches(spark, d), "org", "breach_date")


@query(
    "j08_attribute_in_window",
    f"""SELECT breach_id, article_id FROM breaches_v b JOIN articles_v a ON b.org = a.org
        AND breach_date < article_date
        AND date_diff('day', breach_date, article_date) < {MAX_DAYS}""",
    ("breaches_v", "articles_v"),
)
def j08(spark, d):
    b = breaches(spark, d).select("breach_id", "org", "breach_date")
    a = articles(spark, d).select("article_id", F.col("org").alias("article_org"), "article_date")
    pairs = A.attribute_in_window(
        b, a, [("org", "article_org")], "breach_date", "article_date", MAX_DAYS
    )
    return pairs.select("breach_id", "article_id")


# One event an organisation in every second year, so that the smallest gap is a long one.
@query(
    "j08_attribute_in_learned_window",
    """WITH firsts AS (SELECT org, min(breach_date) AS breach_date FROM breaches_v
                       WHERE year(breach_date) % 2 = 0 GROUP BY org, year(breach_date)),
            gaps AS (SELECT date_diff('day', lag(breach_date) OVER (PARTITION BY org ORDER BY breach_date),
                                      breach_date) AS gap FROM firsts)
       SELECT e.org, breach_date, article_id FROM firsts e JOIN articles_v a ON e.org = a.org
       AND article_date > breach_date
       AND date_diff('day', breach_date, article_date) < (SELECT min(gap) - 1 FROM gaps)""",
    ("breaches_v", "articles_v"),
)
def j08_learned(spark, d):
    """The window is the smallest gap between two events of an organisation less a day."""
    year = F.year("breach_date")
    events = breaches(spark, d).filter(year % 2 == 0).groupBy("org", year).agg(F.min("breach_date").alias("breach_date"))
    a = articles(spark, d).select("article_id", F.col("org").alias("article_org"), "article_date")
    pairs = A.attribute_in_window(
        events.select("org", "breach_date"), a, [("org", "article_org")], "breach_date", "article_date"
    )
    return pairs.select("org", "breach_date", "article_id")


J09_SQL = f"""SELECT breach_id, article_id FROM breaches_v b LEFT JOIN articles_v a ON b.org = a.org
        AND breach_date < article_date AND date_diff('day', breach_date, article_date) < {MAX_DAYS}"""


def _left(spark, d, keep_uncovered):
    b = breaches(spark, d).select("breach_id", "org", "breach_date")
    a = articles(spark, d).select("article_id", F.col("org").alias("article_org"), "article_date")
    pairs = A.attribute_in_window_left(
        b, a, [("org", "article_org")], "breach_id", "breach_date", "article_date", MAX_DAYS,
        keep_uncovered, null_safe=not keep_uncovered,
    )
    return pairs.select("breach_id", "article_id")


@query("j09_attribute_in_window_left", J09_SQL, ("breaches_v", "articles_v"))
def j09(spark, d):
    return _left(spark, d, True)


@query(
    "j09_attribute_filter_after_join",
    f"""SELECT breach_id, article_id FROM breaches_v b LEFT JOIN articles_v a
        ON b.org IS NOT DISTINCT FROM a.org
        WHERE article_date IS NULL OR (breach_date < article_date
          AND date_diff('day', breach_date, article_date) < {MAX_DAYS})""",
    ("breaches_v", "articles_v"),
)
def j09_filtered(spark, d):
    return _left(spark, d, False)


@query(
    "j10_outer_fill",
    """SELECT coalesce(a.n_name, b.n_name, c.n_name) AS country, coalesce(a.n, 0) AS n_customers,
              coalesce(b.n, 0) AS n_suppliers, coalesce(c.n, 0) AS n_rich
       FROM (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
             GROUP BY 1) a
       FULL JOIN (SELECT n_name, count(*) AS n FROM supplier JOIN nation
                  ON s_nationkey = n_nationkey GROUP BY 1) b ON a.n_name = b.n_name
       FULL JOIN (SELECT n_name, count(*) AS n FROM customer JOIN nation
                  ON c_nationkey = n_nationkey WHERE c_acctbal > 9900 GROUP BY 1) c
         ON coalesce(a.n_name, b.n_name) = c.n_name""",
)
def j10(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    customer = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    tables = [
        count_by(customer, ["country"], "n_customers"),
        count_by(supplier, ["country"], "n_suppliers"),
        count_by(customer.filter("c_acctbal > 9900"), ["country"], "n_rich"),
    ]
    return J.outer_fill(tables, "country")


@query(
    "j11_natural_join_all",
    """SELECT lang, source, n_docs, n_labelled FROM (
         SELECT lang, source, count(*) AS n_docs FROM documents GROUP BY ALL) NATURAL JOIN (
         SELECT lang, source, count(*) AS n_labelled FROM documents
         WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY ALL)""",
)
def j11(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, d, "labels"), "doc_id", "left_semi")
    return J.natural_join_all(
        docs.groupBy("lang", "source").agg(F.count("*").alias("n_docs")),
        labelled.groupBy("lang", "source").agg(F.count("*").alias("n_labelled")),
    )


@query(
    "j12_anti_by_values",
    """SELECT doc_id, text FROM documents WHERE NOT EXISTS (
         SELECT 1 FROM documents x WHERE x.text = documents.text AND x.n_chars > 500)""",
)
def j12(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    return J.anti_by_values(docs, docs.filter("n_chars > 500"), "text").select("doc_id", "text")


@query(
    "j13_left_join_fill",
    """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(n_big, 0) AS n_big
       FROM customer
       LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
         USING (c_custkey)
       LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_big FROM orders
                  WHERE o_totalprice > 450000 GROUP BY 1) USING (c_custkey)""",
)
def j13(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    extras = [
        count_by(orders, ["c_custkey"], "n_orders"),
        count_by(orders.filter("o_totalprice > 450000"), ["c_custkey"], "n_big"),
    ]
    return J.left_join_fill(table(spark, d, "customer").select("c_custkey"), extras, ["c_custkey"])


@query(
    "j14_align_raters",
    """SELECT doc_id, a.quality AS quality_a, a.toxic AS toxic_a, b.quality AS quality_b,
              b.toxic AS toxic_b FROM rater_a a JOIN rater_b b USING (doc_id)""",
    ("rater_a", "rater_b"),
)
def j14(spark, d):
    return J.align_raters({"a": rater_a(spark, d), "b": rater_b(spark, d)}, ["doc_id"])


@query(
    "j15_overlap_counts",
    """WITH a AS (SELECT doc_id FROM documents), b AS (SELECT doc_id FROM labels),
            j AS (SELECT count(*) AS n FROM a JOIN b USING (doc_id))
       SELECT n AS in_both, (SELECT count(*) FROM a) - n AS only_a,
              (SELECT count(*) FROM b) - n AS only_b FROM j""",
)
def j15(spark, d):
    return J.overlap_counts(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("j16_join_fuzzy")
def j16(spark, d):
    """Headlines of pages matched to the distinct headlines of all pages.

    No SQL: the score is a longest-common-subsequence ratio.
    """
    pages = headlines(spark, d).select("page_id", "headline")
    names = pages.select(F.col("headline").alias("name")).distinct()
    return join_fuzzy(pages, names, "headline", "name", 90)


@query(
    "j17_broadcast_lookup",
    """SELECT p_partkey, n, mean_price FROM part LEFT JOIN (
         SELECT p_type, count(*) AS n, round(avg(p_retailprice), 6) AS mean_price
         FROM part GROUP BY p_type) USING (p_type)""",
)
def j17(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    stats = part.groupBy("p_type").agg(
        F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 6).alias("mean_price")
    )
    return J.broadcast_lookup(part, stats, ["p_type"]).select("p_partkey", "n", "mean_price")


@query(
    "j18_ratio_by_key",
    """SELECT publication, round(n_breach / n, 9) AS ratio,
              CAST(round_even(n_breach / n * 100, 2) AS VARCHAR) || '%' AS percent
       FROM (SELECT publication, count(*) AS n, count(*) FILTER (label = 'True') AS n_breach
             FROM articles_v GROUP BY 1)""",
    ("articles_v",),
)
def j18(spark, d):
    rows = articles(spark, d).select("publication", "label")
    part = count_by(rows.filter("label = 'True'"), ["publication"], "n_breach")
    whole = count_by(rows, ["publication"], "n")
    out = J.ratio_by_key(part, whole, "publication", "n_breach", "n")
    return out.select("publication", F.round("ratio", 9).alias("ratio"), "percent")


@query(
    "u01_union_all",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS industry FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def u01(spark, d):
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"),
    )
    supplier = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return U.union_all([customer, supplier])


@query(
    "u02_rows_once",
    """SELECT lang, source, text FROM (
         SELECT lang, source, text FROM documents
         UNION ALL SELECT lang, source, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
       GROUP BY ALL HAVING count(*) = 1""",
)
def u02(spark, d):
    """Documents that are neither labelled nor a copy of another one."""
    docs = table(spark, d, "documents")
    labelled = docs.join(table(spark, d, "labels"), "doc_id", "left_semi")
    columns = ["lang", "source", "text"]
    return U.rows_once(docs.select(*columns), labelled.select(*columns))


@query(
    "u03_intersect_keys",
    "SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents",
)
def u03(spark, d):
    return U.intersect_keys([table(spark, d, "labels"), table(spark, d, "documents")], ["doc_id"])


@query(
    "u04_unpivot",
    """SELECT p_type, measure, value FROM (
         SELECT p_type, CAST(count(*) AS DOUBLE) AS n, CAST(max(p_size) AS DOUBLE) AS largest
         FROM part GROUP BY p_type) UNPIVOT (value FOR measure IN (n, largest))""",
)
def u04(spark, d):
    wide = table(spark, d, "part").groupBy("p_type").agg(
        F.count("*").cast("double").alias("n"), F.max("p_size").cast("double").alias("largest")
    )
    return U.unpivot(wide, ["p_type"], ["n", "largest"], "measure", "value")


@query("g01_synthetic_star")
def g01(spark, d):
    """A synthetic article per event row and a synthetic breach per user of the given tables."""
    events = table(spark, d, "events").select("event_id", "user_id")
    stories = synthetic_articles(events, "event_id", "user_id")
    leaks = synthetic_events(events.select("user_id").distinct(), "user_id")
    corps = synthetic_corporations(leaks, "corp_name")
    return stories.join(leaks, "breach_id").join(corps, "corp_name")


@query(
    "g02_orphan_keys",
    """SELECT doc_id, n_chars FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def g02(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("child_id"), "n_chars")
    orphans = orphan_keys(docs, table(spark, d, "labels"), "child_id", "doc_id")
    return orphans.withColumnRenamed("child_id", "doc_id")
