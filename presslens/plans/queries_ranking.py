"""W and L: ranking, chunking, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import attribution as A, ranking as R
from presslens.plans.registry import query
from presslens.plans.views import articles, breaches, headlines, table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "w01_top_n_by_count",
    """SELECT headline, count(*) AS count FROM articles_v GROUP BY 1
       ORDER BY count DESC, headline LIMIT 15""",
    ("articles_v",),
)
def w01(spark, d):
    return R.top_n_by_count(articles(spark, d), "headline", 15)


@query(
    "w01_bottom_n_by_count",
    """SELECT headline, count(*) AS count FROM articles_v GROUP BY 1
       ORDER BY count, headline LIMIT 30""",
    ("articles_v",),
)
def w01_bottom(spark, d):
    return R.top_n_by_count(articles(spark, d), "headline", 30, ascending=True)


@query(
    "w02_top_k_per_top_group",
    """WITH c AS (SELECT publication, org, count(*) AS count FROM articles_v GROUP BY ALL),
            g AS (SELECT publication FROM c GROUP BY 1 ORDER BY sum(count) DESC, publication LIMIT 10)
       SELECT publication, org, count, rank FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY publication ORDER BY count DESC, org)
                        AS INTEGER) AS rank
         FROM c WHERE publication IN (SELECT publication FROM g)) WHERE rank <= 5""",
    ("articles_v",),
)
def w02(spark, d):
    rows = articles(spark, d).select("publication", "org")
    return R.top_k_per_top_group(rows, "publication", "org", 10, 5)


@query(
    "w03_best_per_group",
    """SELECT sector, org, n FROM (
         SELECT sector, org, count(*) AS n,
                row_number() OVER (PARTITION BY sector ORDER BY count(*) DESC, org) AS rn
         FROM breaches_v GROUP BY sector, org) WHERE rn = 1""",
    ("breaches_v",),
)
def w03(spark, d):
    counts = breaches(spark, d).groupBy("sector", "org").agg(F.count("*").alias("n"))
    return R.best_per_group(counts, "sector", "org", "n")


@query(
    "w04_assign_chunks",
    """SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 500 AS BIGINT) AS chunk
       FROM events""",
)
def w04(spark, d):
    return R.assign_chunks(table(spark, d, "events").select("event_id"), ["event_id"], 500)


@query(
    "w04_assign_shards",
    """SELECT event_id, CAST(least((row_number() OVER (ORDER BY event_id) - 1)
                               // ((SELECT count(*) FROM events) // 7), 6) AS BIGINT) AS shard
       FROM events""",
)
def w04_shards(spark, d):
    return R.assign_shards(table(spark, d, "events").select("event_id"), ["event_id"], 7)


@query(
    "w05_lag_gap",
    """SELECT org, breach_date, CAST(date_diff('day', lag(breach_date) OVER (
                PARTITION BY org ORDER BY breach_date), breach_date) AS INTEGER) AS gap_days
       FROM (SELECT DISTINCT org, breach_date FROM breaches_v)""",
    ("breaches_v",),
)
def w05(spark, d):
    return A.event_gaps(breaches(spark, d), "org", "breach_date")


@query(
    "l01_sort_by_key",
    "SELECT page_id, headline FROM headlines_v ORDER BY lower(headline), page_id",
    ("headlines_v",),
)
def l01(spark, d):
    rows = headlines(spark, d).select("page_id", "headline")
    return R.sort_by_key(rows, F.lower("headline"), "page_id")


@query(
    "l02_sort_by_ordinal",
    """SELECT o_orderkey, o_orderpriority FROM orders
       ORDER BY CAST(left(o_orderpriority, 1) AS INTEGER), o_orderkey""",
)
def l02(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return R.sort_by_ordinal(rows, "o_orderpriority", PRIORITIES, "o_orderkey")


@query(
    "l03_sort_multi_limit",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
       ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25""",
)
def l03(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return R.sort_multi(rows, ["o_orderpriority", F.desc("o_totalprice"), "o_orderkey"], 25)


@query("l04_sample_n")
def l04(spark, d):
    return R.sample_n(headlines(spark, d).select("page_id", "headline"), ["page_id"], 200)


@query("l05_train_test_split")
def l05(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang")
    train, test = R.train_test_split(rows, ["doc_id"], 0.8)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
