"""V: vectors, sampling and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import components as K, vectors as V
from presslens.plans.registry import query
from presslens.plans.views import companies, headlines, table


def _vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label")


@query(
    "v01_normalise_vectors",
    """WITH u AS (SELECT vec_id, unnest(range(len(embedding))) AS pos,
                         unnest(embedding)::DOUBLE AS x FROM embeddings),
            c AS (SELECT vec_id, pos, x - avg(x) OVER w AS c,
                         var_pop(x) OVER w AS v FROM u WINDOW w AS (PARTITION BY vec_id)),
            l AS (SELECT vec_id, pos, c / sqrt(v + 1e-5) AS y FROM c)
       SELECT vec_id, CAST(pos AS INTEGER) AS pos,
              round(y / sqrt(sum(y * y) OVER (PARTITION BY vec_id)), 9) AS value FROM l""",
)
def v01(spark, d):
    unit = V.normalise_vectors(_vectors(spark, d), "embedding")
    cells = unit.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.withColumn("value", F.round("value", 9))


@query(
    "v01_mean_pooling",
    """WITH u AS (SELECT label, unnest(range(len(embedding))) AS pos,
                         unnest(embedding)::DOUBLE AS x FROM embeddings)
       SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(x), 9) AS value FROM u GROUP BY ALL""",
)
def v01_pooling(spark, d):
    pooled = V.mean_pooling(_vectors(spark, d), ["label"], "embedding")
    cells = pooled.select("label", F.posexplode("pooled").alias("pos", "value"))
    return cells.withColumn("value", F.round("value", 9))


@query(
    "v02_vector_bounds",
    """SELECT CAST(pos AS INTEGER) AS dim, min(x) AS low, max(x) AS high FROM (
         SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings)
       GROUP BY pos""",
)
def v02(spark, d):
    return V.vector_bounds(_vectors(spark, d), "embedding")


@query(
    "v03_knn",
    """SELECT query_id, neighbour_id, CAST(rank AS INTEGER) AS rank, round(dist, 9) AS distance FROM (
         SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id,
                pow(list_distance(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2) AS dist,
                row_number() OVER (PARTITION BY q.vec_id ORDER BY dist, b.vec_id) AS rank
         FROM embeddings q JOIN embeddings b ON true) WHERE rank <= 3""",
)
def v03(spark, d):
    rows = _vectors(spark, d)
    found = V.knn(rows.withColumnRenamed("vec_id", "query_id"), rows, "query_id", "vec_id", "embedding", 3)
    return found.withColumn("distance", F.round("distance", 9))


@query(
    "v04_sample_diagonal",
    """WITH u AS (SELECT unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x
                  FROM embeddings),
            b AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM u GROUP BY pos),
            p AS (SELECT i, list(lo + (hi - lo) * (i / 199.0::DOUBLE) ORDER BY pos) AS point
                  FROM b JOIN range(200) t(i) ON true GROUP BY i)
       SELECT DISTINCT vec_id FROM (
         SELECT e.vec_id, row_number() OVER (
           PARTITION BY i ORDER BY list_distance(point, e.embedding::DOUBLE[]), e.vec_id) AS rn
         FROM p JOIN embeddings e ON true) WHERE rn = 1""",
)
def v04(spark, d):
    return V.sample_diagonal(_vectors(spark, d), "vec_id", "embedding", 200).select("vec_id")


@query("v05_sample_kmeans")
def v05(spark, d):
    sampled = V.sample_kmeans(_vectors(spark, d), "vec_id", "embedding", k=20)
    return sampled.select("vec_id", "label")


@query("v06_kmeans_custom")
def v06(spark, d):
    return V.kmeans_custom(_vectors(spark, d), "vec_id", "embedding", k=10)


@query(
    "v07_cluster_by_predicate",
    """WITH RECURSIVE e AS (
         SELECT a.page_id AS src, b.page_id AS dst FROM headlines_v a JOIN headlines_v b
           ON a.headline = b.headline OR a.domain = b.domain),
       reach AS (SELECT page_id AS node, page_id AS seen FROM headlines_v
                 UNION SELECT reach.node, e.dst FROM reach JOIN e ON e.src = reach.seen)
       SELECT node AS page_id, min(seen) AS component FROM reach GROUP BY node""",
    ("headlines_v",),
)
def v07(spark, d):
    """Pages with the same headline or the same domain belong together."""
    pages = headlines(spark, d).select("page_id", "headline", "domain")
    edges = K.edges_same_key(pages, "page_id", F.col("headline")).unionByName(
        K.edges_same_key(pages, "page_id", F.col("domain"))
    )
    return K.cluster(pages, "page_id", edges)


@query(
    "v07_cluster_within_distance",
    """SELECT event_id, min(event_id) OVER (PARTITION BY user_id, run) AS component FROM (
         SELECT event_id, user_id, sum(step) OVER (PARTITION BY user_id ORDER BY value, event_id) AS run
         FROM (SELECT event_id, user_id, value, CASE WHEN value - lag(value) OVER (
                 PARTITION BY user_id ORDER BY value, event_id) <= 0.5 THEN 0 ELSE 1 END AS step
               FROM events))""",
)
def v07_within(spark, d):
    """Events of a user chained by values at most 0.5 apart."""
    events = table(spark, d, "events").select("event_id", "user_id", "value")
    return K.cluster(events, "event_id", K.edges_within(events, "event_id", "value", 0.5, ["user_id"]))


@query(
    "v07_cluster_by_rule",
    """WITH RECURSIVE e AS (
         SELECT a.company_id AS src, b.company_id AS dst FROM companies_v a JOIN companies_v b
           ON a.country = b.country AND a.industry = b.industry
          AND abs(a.size - b.size) * 50 <= greatest(abs(a.size), abs(b.size))),
       reach AS (SELECT company_id AS node, company_id AS seen FROM companies_v
                 UNION SELECT reach.node, e.dst FROM reach JOIN e ON e.src = reach.seen)
       SELECT node AS company_id, min(seen) AS component FROM reach GROUP BY node""",
    ("companies_v",),
)
def v07_rule(spark, d):
    """Companies of a country and industry whose sizes differ by at most 2 % of the larger one."""
    known = companies(spark, d).select("company_id", "country", "industry", "size")

    def close(a, b):
        larger = F.greatest(F.abs(a("size")), F.abs(b("size")))
        return F.abs(a("size") - b("size")) * 50 <= larger

    # Two sizes that are close have only sizes between them that are close to both.
    edges = K.edges_by_predicate(known, "company_id", close, ["country", "industry"], order="size")
    return K.cluster(known, "company_id", edges)


@query("v07_cluster_fuzzy")
def v07_fuzzy(spark, d):
    """Pages whose headlines are at least 90 alike, chained."""
    pages = headlines(spark, d).select("page_id", "headline")
    return K.cluster(pages, "page_id", K.edges_fuzzy(pages, "page_id", "headline", 90))
