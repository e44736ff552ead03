"""Domain views over the given tables, as DataFrames and as the same SELECT in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def companies(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    return (
        table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("company_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("industry"),
            F.col("n_name").alias("country"),
            F.col("c_acctbal").alias("size"),
        )
    )


def breaches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("breach_id"),
        F.col("o_custkey").alias("org"),
        F.concat(F.lit("Customer-"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias(
            "organisation"
        ),
        F.to_date("o_orderdate").alias("breach_date"),
        F.col("o_totalprice").alias("records"),
        F.col("o_orderpriority").alias("sector"),
        F.col("o_orderstatus").alias("method"),
    )


def articles(spark: SparkSession, d: str) -> DataFrame:
    item, order = table(spark, d, "lineitem"), table(spark, d, "orders")
    source = table(spark, d, "supplier").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return (
        item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(source, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "article_id"
            ),
            F.concat_ws("/", "l_orderkey", "l_linenumber").alias("url"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("headline"),
            F.col("n_name").alias("publication"),
            F.to_date("l_shipdate").alias("article_date"),
            F.when(F.col("l_returnflag") == "A", "True")
            .when(F.col("l_returnflag") == "R", "yes")
            .otherwise("False")
            .alias("label"),
            F.col("o_custkey").alias("org"),
            F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias(
                "mention"
            ),
            F.col("o_orderpriority").alias("sector"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    """Companies with multi-word, partly shared names."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws(" ", "p_name", "p_brand", "p_size").alias("name"),
        F.col("p_type").alias("industry"),
        F.col("p_retailprice").alias("size"),
    )


def product_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Articles naming a product exactly (`full_mention`) and by the start of its name."""
    item, part = table(spark, d, "lineitem"), table(spark, d, "part")
    return item.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("article_id"),
        F.upper(F.concat_ws(" ", "p_name", "p_brand", "p_size")).alias("full_mention"),
        F.upper(F.concat_ws(" ", "p_name", "p_brand")).alias("mention"),
    )


def headlines(spark: SparkSession, d: str) -> DataFrame:
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    domain = F.regexp_replace(host, r"^(www|m|blog)[.]", "")
    return table(spark, d, "pages").select(
        "page_id",
        "url",
        host.alias("publication"),
        domain.alias("domain"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("headline"),
    )


def rater_a(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic")
    )


def rater_b(spark: SparkSession, d: str) -> DataFrame:
    """A rule-based rater of the documents."""
    return table(spark, d, "documents").select(
        "doc_id",
        (F.col("n_chars") > 300).alias("quality"),
        F.lower("text").rlike("idiot|pathetic").alias("toxic"),
    )


SQL_VIEWS = {
    "companies_v": """
        SELECT c_custkey AS company_id, c_name AS name, c_mktsegment AS industry,
               n_name AS country, c_acctbal AS size
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "breaches_v": """
        SELECT o_orderkey AS breach_id, o_custkey AS org,
               'Customer-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS organisation,
               CAST(o_orderdate AS DATE) AS breach_date, o_totalprice AS records,
               o_orderpriority AS sector, o_orderstatus AS method
        FROM orders""",
    "articles_v": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS article_id,
               concat_ws('/', l_orderkey, l_linenumber) AS url,
               'part ' || CAST(l_partkey AS VARCHAR) AS headline, n_name AS publication,
               CAST(l_shipdate AS DATE) AS article_date,
               CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'R' THEN 'yes' ELSE 'False' END AS label,
               o_custkey AS org,
               'CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS mention,
               o_orderpriority AS sector, l_quantity AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "products_v": """
        SELECT p_partkey AS product_id, concat_ws(' ', p_name, p_brand, p_size) AS name,
               p_type AS industry, p_retailprice AS size FROM part""",
    "product_mentions_v": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS article_id,
               upper(concat_ws(' ', p_name, p_brand, p_size)) AS full_mention,
               upper(concat_ws(' ', p_name, p_brand)) AS mention
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "headlines_v": r"""
        SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS publication,
               regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1),
                              '^(www|m|blog)[.]', '') AS domain,
               regexp_extract(html, '<title>(.*?)</title>', 1) AS headline
        FROM pages""",
    "rater_a": """
        SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels""",
    "rater_b": """
        SELECT doc_id, n_chars > 300 AS quality,
               regexp_matches(lower(text), 'idiot|pathetic') AS toxic FROM documents""",
}


def with_views(sql: str, *names: str) -> str:
    """Put the named views in front of a SELECT (which may bring its own WITH)."""
    parts = ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"
