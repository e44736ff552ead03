"""P and D: projections, filters, cleaning and deduplication; F: scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.operators import cleaning as C, dedup as D
from presslens.plans.registry import query
from presslens.plans.views import articles, headlines, products, rater_a, rater_b, table

# A dirty label column made of the line flags.
DIRTY_SQL = """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'True'
    WHEN l_returnflag = 'A' THEN ' Yes ' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '0'
    WHEN l_returnflag = 'R' THEN 'AT&T' WHEN l_linestatus = 'F' THEN NULL ELSE '' END"""
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(LINE_KEY)


def _dirty(spark, d):
    return table(spark, d, "lineitem").select(*LINE_KEY, F.expr(DIRTY_SQL).alias("label"))


@query(
    "p01_normalise_headers",
    "SELECT p_brand AS brand, p_partkey AS id, p_size AS size FROM part",
)
def p01(spark, d):
    part = table(spark, d, "part").select(
        F.col("p_size").alias("size   "),
        F.col("p_partkey").alias(" partkey"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("Unnamed: 0"),
    )
    return C.normalise_headers(part, {"partkey": "id"}, sort=True)


@query(
    "p02_drop_null",
    f"SELECT {KEY_SQL}, {DIRTY_SQL} AS label FROM lineitem WHERE ({DIRTY_SQL}) IS NOT NULL",
)
def p02(spark, d):
    return C.drop_null(_dirty(spark, d), ["label"])


@query(
    "p03_exclude_values",
    f"""SELECT * FROM (SELECT {KEY_SQL}, {DIRTY_SQL} AS label FROM lineitem)
        WHERE coalesce(label NOT IN ('0', 'True'), true)""",
)
def p03(spark, d):
    return C.exclude_values(_dirty(spark, d), "label", ["0", "True"])


@query(
    "p04_drop_embedded_headers",
    "SELECT event_id, event_type FROM events WHERE event_type <> 'view'",
)
def p04(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type")
    # The word 'view' plays the repeated header of a column with that name.
    named = rows.withColumnRenamed("event_type", "view")
    return C.drop_embedded_headers(named, ["view"]).withColumnRenamed("view", "event_type")


@query(
    "p05_fill_null",
    f"SELECT {KEY_SQL}, coalesce({DIRTY_SQL}, 'False') AS label FROM lineitem",
)
def p05(spark, d):
    return C.fill_null(_dirty(spark, d), {"label": "False"})


@query(
    "p06_sentinel_to_null",
    "SELECT p_partkey, nullif(p_size, 1) AS p_size FROM part",
)
def p06(spark, d):
    return C.sentinel_to_null(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", 1)


@query(
    "p07_parse_grouped_number",
    "SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS records FROM orders",
)
def p07(spark, d):
    grouped = F.format_number(F.round("o_totalprice"), 0)
    rows = table(spark, d, "orders").select("o_orderkey", grouped.alias("text"))
    return rows.select("o_orderkey", X.parse_grouped_number(F.col("text")).alias("records"))


@query(
    "p08_digits_only_rows",
    """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 2) AS VARCHAR) AS name,
              CAST(left(o_orderpriority, 1) AS BIGINT) AS level
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def p08(spark, d):
    level = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.split("o_orderpriority", "-")[1].alias("name"), level.alias("level")
    )
    return C.digits_only_rows(rows, ["level"])


@query(
    "p09_parse_month_year",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
)
def p09(spark, d):
    text = F.date_format("o_orderdate", "MMM yyyy")
    rows = table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", X.parse_month_year(F.col("text")).alias("month"))


@query("p10_parse_yyyymmdd", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def p10(spark, d):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    rows = table(spark, d, "orders").select("o_orderkey", number.alias("number"))
    return rows.select("o_orderkey", X.parse_yyyymmdd(F.col("number")).alias("day"))


@query(
    "p11_epoch_to_ts",
    "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
)
def p11(spark, d):
    rows = table(spark, d, "events").select("event_id", F.unix_timestamp("ts").alias("epoch"))
    return rows.select("event_id", X.epoch_to_ts(F.col("epoch")).cast("timestamp_ntz").alias("ts"))


@query(
    "p12_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_int,
              CAST(year(o_orderdate) AS INTEGER) AS year_text,
              CAST(month(o_orderdate) AS INTEGER) AS month_text,
              CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start FROM orders""",
)
def p12(spark, d):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    year, month = X.split_year_month(F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        X.year_of_yyyymmdd(number).alias("year_int"),
        year.alias("year_text"),
        month.alias("month_text"),
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("year_start"),
    )


@query(
    "p13_between_dates",
    """SELECT o_orderkey FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'""",
)
def p13(spark, d):
    first, last = dt.datetime(1996, 1, 1), dt.datetime(1998, 6, 30)
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    # Order dates carry no time of day, so the pushed timestamp range equals the day range.
    return C.between_dates(rows, "o_orderdate", first, last).select("o_orderkey")


NORMALISED_SQL = r"lower(regexp_replace(coalesce({0}, ''), '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g'))"


@query(
    "p14_normalise_name",
    f"SELECT doc_id, {NORMALISED_SQL.format('text')} AS name FROM documents",
)
def p14(spark, d):
    return table(spark, d, "documents").select("doc_id", X.normalise_name(F.col("text")).alias("name"))


@query("p15_lower_key", "SELECT page_id, lower(headline) AS key FROM headlines_v", ("headlines_v",))
def p15(spark, d):
    return headlines(spark, d).select("page_id", X.lower_key(F.col("headline")).alias("key"))


@query(
    "p16_to_bool",
    f"""SELECT {KEY_SQL},
          CASE WHEN t IS NULL OR t IN ('nan', 'false', 'no', '0') THEN false ELSE t <> '' END AS lenient,
          coalesce(t IN ('true', 'yes', '1'), false) AS strict,
          coalesce(length(raw) > 0 AND lower(raw) NOT IN ('nan', 'false', '0'), false) AS presence
        FROM (SELECT {KEY_SQL}, {DIRTY_SQL} AS raw, lower(trim({DIRTY_SQL})) AS t FROM lineitem)""",
)
def p16(spark, d):
    label = F.col("label")
    return _dirty(spark, d).select(
        *LINE_KEY, *(X.to_bool(label, m).alias(m) for m in ("lenient", "strict", "presence"))
    )


@query(
    "p17_recode",
    """SELECT p_partkey,
         CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'cheap' END AS strict_type,
         CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'cheap' ELSE p_type END AS kept_type
       FROM part""",
)
def p17(spark, d):
    groups = {"ECONOMY": "cheap", "PROMO": "cheap"}
    rows = table(spark, d, "part").select("p_partkey", "p_type")
    rows = C.recode(rows, "p_type", groups, out="strict_type")
    return C.recode(rows, "p_type", groups, out="kept_type", keep=True).drop("p_type")


@query(
    "p18_whitelist_else_other",
    """SELECT p_partkey,
         CASE WHEN p_type IN ('LARGE', 'SMALL') THEN p_type ELSE 'other' END AS listed,
         CASE WHEN p_brand IN (SELECT p_brand FROM part GROUP BY 1
                               ORDER BY count(*) DESC, p_brand LIMIT 5)
              THEN p_brand ELSE 'other' END AS top_brand
       FROM part""",
)
def p18(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_type", "p_brand")
    rows = C.whitelist_else_other(rows, "p_type", ["LARGE", "SMALL"], "listed")
    rows = C.top_n_else_other(rows, "p_brand", 5, "top_brand")
    return rows.select("p_partkey", "listed", "top_brand")


@query(
    "p19_indicator_columns",
    """SELECT event_id, event_type = 'click' AS is_click, event_type = 'error' AS is_error,
              value > 20 AS has_value FROM events""",
)
def p19(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", "event_type", (F.col("value") > 20).alias("has_value")
    )
    return C.indicator_columns(rows, "event_type", ["click", "error"], "is_").drop("event_type")


@query(
    "p20_derive_by_name_pattern",
    """SELECT user_id, posts, comments, posts_in_sub, comments_in_sub, posts + comments AS items,
              posts_in_sub + comments_in_sub AS items_in_sub,
              posts - posts_in_sub AS posts_excl_sub,
              comments - comments_in_sub AS comments_excl_sub,
              posts + comments - posts_in_sub - comments_in_sub AS items_excl_sub
       FROM (SELECT user_id, count(*) FILTER (event_type = 'view') AS posts,
                    count(*) FILTER (event_type = 'click') AS comments,
                    count(*) FILTER (event_type = 'view' AND value < 10) AS posts_in_sub,
                    count(*) FILTER (event_type = 'click' AND value < 10) AS comments_in_sub
             FROM events GROUP BY user_id)""",
)
def p20(spark, d):
    kind, low = F.col("event_type"), F.col("value") < 10
    counts = table(spark, d, "events").groupBy("user_id").agg(
        F.count_if(kind == "view").alias("posts"),
        F.count_if(kind == "click").alias("comments"),
        F.count_if((kind == "view") & low).alias("posts_in_sub"),
        F.count_if((kind == "click") & low).alias("comments_in_sub"),
    )
    return C.derive_by_name_pattern(counts)


@query(
    "p21_map_cells",
    """SELECT c_custkey, printf('%.2f', c_acctbal) AS c_acctbal FROM customer""",
)
def p21(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return C.map_cells(rows, lambda c: F.format_string("%.2f", c), ["c_acctbal"])


@query(
    "p22_keyword_filter",
    r"""SELECT doc_id FROM documents
        WHERE regexp_matches(text, '(?i)(\s|^)(breach|data|hack|record|leak|licen|password)')""",
)
def p22(spark, d):
    words = (*X.BREACH_KEYWORDS, "licen", "password")
    rows = table(spark, d, "documents").select("doc_id", "text")
    return C.keyword_filter(rows, "text", words).select("doc_id")


@query(
    "p23_threshold_filters",
    """SELECT c_custkey, c_acctbal FROM customer
       WHERE c_acctbal >= 5000 AND c_mktsegment = 'BUILDING' AND c_custkey NOT IN (1, 2, 3)""",
)
def p23(spark, d):
    rows = table(spark, d, "customer").filter(
        (F.col("c_acctbal") >= 5000) & (F.col("c_mktsegment") == "BUILDING")
    )
    return C.exclude_values(rows, "c_custkey", [1, 2, 3]).select("c_custkey", "c_acctbal")


@query("p24_distinct_values", "SELECT DISTINCT p_brand FROM part")
def p24(spark, d):
    return C.distinct_values(table(spark, d, "part"), "p_brand")


@query("p25_assert_schema_subset", "SELECT doc_id, lang FROM documents")
def p25(spark, d):
    whole = table(spark, d, "documents")
    part = whole.select("doc_id", "lang")
    C.assert_schema_subset(part, whole)
    return part


@query(
    "p26_select_disagree",
    """SELECT a.doc_id, a.quality AS label_a, b.quality AS label_b
       FROM rater_a a JOIN rater_b b USING (doc_id) WHERE a.quality <> b.quality""",
    ("rater_a", "rater_b"),
)
def p26(spark, d):
    a = rater_a(spark, d).select("doc_id", F.col("quality").cast("string").alias("label_a"))
    b = rater_b(spark, d).select("doc_id", F.col("quality").cast("string").alias("label_b"))
    return C.select_disagree(a.join(b, "doc_id"), "label_a", "label_b")


@query(
    "d01_dedup_first",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY headline ORDER BY page_id) AS rn
                  FROM headlines_v),
            b AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS rn2
                  FROM a WHERE rn = 1)
       SELECT page_id, headline, domain FROM b WHERE rn2 = 1""",
    ("headlines_v",),
)
def d01(spark, d):
    once = D.keep_first(headlines(spark, d), ["headline"], ["page_id"])
    return D.keep_first(once, ["domain"], ["page_id"]).select("page_id", "headline", "domain")


@query("d02_dedup_rows", "SELECT DISTINCT source, lang, text FROM documents")
def d02(spark, d):
    return D.dedup_rows(table(spark, d, "documents").select("source", "lang", "text"))


@query(
    "d03_keep_earliest",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY article_date, article_id) AS rn
                  FROM articles_v),
            b AS (SELECT *, row_number() OVER (PARTITION BY headline, publication
                                               ORDER BY article_date, article_id) AS rn2
                  FROM a WHERE rn = 1)
       SELECT article_id, url, headline, publication, article_date FROM b WHERE rn2 = 1""",
    ("articles_v",),
)
def d03(spark, d):
    kept = D.keep_earliest(
        articles(spark, d), [["url"], ["headline", "publication"]], "article_date", ["article_id"]
    )
    return kept.select("article_id", "url", "headline", "publication", "article_date")


@query(
    "d04_keep_largest",
    """SELECT article_id, url, headline, quantity FROM (
         SELECT *, row_number() OVER (PARTITION BY headline, url
                                      ORDER BY quantity DESC, article_id) AS rn
         FROM articles_v) WHERE rn = 1""",
    ("articles_v",),
)
def d04(spark, d):
    kept = D.keep_largest(articles(spark, d), ["headline", "url"], "quantity", ["article_id"])
    return kept.select("article_id", "url", "headline", "quantity")


@query(
    "d05_members_of_duplicate_groups",
    """SELECT product_id, name FROM products_v
       WHERE name IN (SELECT name FROM products_v GROUP BY name HAVING count(*) > 1)""",
    ("products_v",),
)
def d05(spark, d):
    return D.members_of_duplicate_groups(
        products(spark, d).select("product_id", "name"), ["name"]
    )


@query(
    "f01_scalar_suite",
    r"""SELECT o_orderkey,
         lower(o_orderpriority) AS low, trim('  ' || o_orderstatus || ' ') AS trimmed,
         trim('"' || o_orderstatus || '"', '"') AS unquoted,
         starts_with(o_orderpriority, '1') AS is_first, substr(o_orderpriority, 3) AS tail,
         split_part(o_orderpriority, '-', 1) AS head, replace(o_orderpriority, 'H', 'h') AS swapped,
         regexp_matches(substr(o_orderpriority, 1, 1), '^[0-9]+$') AS digits,
         o_orderstatus || ' (' || CAST(year(o_orderdate) AS VARCHAR) || ')' AS titled,
         regexp_replace(o_orderpriority, '[^A-Za-z0-9_\-]', '_', 'g') AS safe,
         printf('%.2f', o_totalprice) AS formatted,
         'search_document: ' || o_orderstatus AS prefixed,
         round(abs(o_totalprice - 200000), 2) AS distance, round(sqrt(o_totalprice), 6) AS root,
         round(pow(o_totalprice / 100000, 2), 6) AS square,
         least(o_totalprice, 100000) AS capped, greatest(o_totalprice, 100000) AS floored,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age
       FROM orders""",
)
def f01(spark, d):
    p, s, t = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.lower(p).alias("low"),
        F.trim(F.concat(F.lit("  "), s, F.lit(" "))).alias("trimmed"),
        F.trim(F.concat(F.lit('"'), s, F.lit('"')), F.lit('"')).alias("unquoted"),
        p.startswith("1").alias("is_first"),
        F.substring(p, 3, 100).alias("tail"),
        F.split(p, "-")[0].alias("head"),
        F.replace(p, F.lit("H"), F.lit("h")).alias("swapped"),
        F.substring(p, 1, 1).rlike("^[0-9]+$").alias("digits"),
        F.concat(s, F.lit(" ("), F.year("o_orderdate").cast("string"), F.lit(")")).alias("titled"),
        X.file_safe(p).alias("safe"),
        F.format_string("%.2f", t).alias("formatted"),
        X.with_document_prefix(s).alias("prefixed"),
        F.round(F.abs(t - 200000), 2).alias("distance"),
        F.round(F.sqrt(t), 6).alias("root"),
        F.round(F.pow(t / 100000, F.lit(2)), 6).alias("square"),
        F.least(t, F.lit(100000.0)).alias("capped"),
        F.greatest(t, F.lit(100000.0)).alias("floored"),
        F.date_diff(F.to_date("o_orderdate"), F.lit(dt.date(1992, 1, 1))).alias("age"),
    )
