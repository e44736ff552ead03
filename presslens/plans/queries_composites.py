"""C: end-to-end analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from presslens.operators.labelling import lines_of
from presslens.plans import composites as P
from presslens.plans.queries_aggregates import SHARES_SQL, is_breach, rounded
from presslens.plans.queries_joins import MAX_DAYS
from presslens.plans.registry import query
from presslens.plans.views import articles, breaches, companies, headlines, table


@query(
    "c01_moderator_features",
    """WITH t AS (SELECT user_id AS mod, event_type AS subreddit, min(ts) AS started, max(ts) AS ended
                  FROM events GROUP BY ALL),
            a AS (SELECT user_id AS mod, event_type AS subreddit,
                         count(*) FILTER (value > 20) AS posts, count(*) FILTER (value <= 20) AS comments,
                         count(*) FILTER (value > 40) AS posts_in_sub,
                         count(*) FILTER (value <= 5) AS comments_in_sub
                  FROM events GROUP BY ALL)
       SELECT t.mod, t.subreddit, started, ended, coalesce(posts, 0) AS posts,
         coalesce(comments, 0) AS comments, coalesce(posts_in_sub, 0) AS posts_in_sub,
         coalesce(comments_in_sub, 0) AS comments_in_sub, coalesce(n, 0) AS n_errors,
         coalesce(posts + comments, 0) AS items, coalesce(posts_in_sub + comments_in_sub, 0) AS items_in_sub,
         coalesce(posts - posts_in_sub, 0) AS posts_excl_sub,
         coalesce(comments - comments_in_sub, 0) AS comments_excl_sub,
         coalesce(posts + comments - posts_in_sub - comments_in_sub, 0) AS items_excl_sub
       FROM t LEFT JOIN a ON t.mod = a.mod AND t.subreddit = a.subreddit
       LEFT JOIN (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type = 'error'
                  GROUP BY ALL) e ON t.mod = e.user_id AND t.subreddit = e.event_type
       WHERE started BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-03'""",
)
def c01(spark, d):
    events = table(spark, d, "events").select(
        F.col("user_id").alias("mod"), F.col("event_type").alias("subreddit"), "ts", "value"
    )
    keys = ["mod", "subreddit"]
    tenures = events.groupBy(*keys).agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))
    value = F.col("value")
    activity = events.groupBy(*keys).agg(
        F.min("ts").alias("started"),
        F.count_if(value > 20).alias("posts"),
        F.count_if(value <= 20).alias("comments"),
        F.count_if(value > 40).alias("posts_in_sub"),
        F.count_if(value <= 5).alias("comments_in_sub"),
    )
    errors = events.filter("subreddit = 'error'").groupBy(*keys).agg(
        F.min("ts").alias("started"), F.count("*").alias("n_errors")
    )
    return P.moderator_features(
        tenures, activity, errors, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)
    )


@query(
    "c02_moderation_counts",
    """WITH o AS (SELECT event_type AS subreddit, CAST(year(ts) AS INTEGER) AS year,
                         CAST(month(ts) AS INTEGER) AS month, count(*) AS all_mod_items,
                         count(*) FILTER (value > 30) AS positive_mod_items,
                         count(*) FILTER (value > 10 AND value <= 30) AS neutral_mod_items,
                         count(*) FILTER (value <= 10) AS negative_mod_items
                  FROM events WHERE event_type NOT IN ('error') GROUP BY ALL),
            r AS (SELECT event_type AS subreddit, CAST(year(ts) AS INTEGER) AS year,
                         CAST(month(ts) AS INTEGER) AS month, count(*) AS removed
                  FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY ALL)
       SELECT subreddit, year, month, removed, all_mod_items, positive_mod_items,
              neutral_mod_items, negative_mod_items FROM r FULL JOIN o USING (subreddit, year, month)""",
)
def c02(spark, d):
    events = table(spark, d, "events")
    value = F.col("value")
    items = events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("subreddit"),
        F.col("ts").alias("created"),
        F.when(value > 30, "positive").when(value > 10, "neutral").otherwise("negative").alias("sentiment"),
    )
    # The same items arrive twice, as from overlapping files.
    removed = events.filter("event_type <> 'view'").groupBy(
        F.col("event_type").alias("subreddit"), F.date_format("ts", "yyyy-MM").alias("month")
    ).agg(F.count("*").alias("removed"))
    return P.moderation_counts(items.union(items), removed, excluded=["error"])


@query(
    "c03_event_coverage",
    rf"""WITH a1 AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY article_date, article_id) AS rn
                    FROM articles_v WHERE label NOT IN ('flase', 'False')),
            a2 AS (SELECT *, row_number() OVER (PARTITION BY headline, publication
                                                ORDER BY article_date, article_id) AS rn2
                   FROM a1 WHERE rn = 1),
            m AS (SELECT article_id, headline, url, article_date, company_id,
                         row_number() OVER (PARTITION BY headline, url ORDER BY size DESC, company_id) AS rn3
                  FROM a2 JOIN companies_v ON regexp_replace(lower(mention), '[^a-z0-9]', '', 'g')
                                            = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')
                  WHERE rn2 = 1),
            e AS (SELECT breaches_v.*, company_id, industry,
                         row_number() OVER (PARTITION BY organisation, records, breach_date
                                            ORDER BY coalesce(size, -1) DESC, breach_id) AS rn4
                  FROM breaches_v LEFT JOIN companies_v
                  ON regexp_replace(lower(organisation), '[^a-z0-9]', '', 'g')
                   = regexp_replace(lower(name), '[^a-z0-9]', '', 'g'))
       SELECT e.breach_id, any_value(organisation) AS organisation, any_value(e.breach_date) AS breach_date,
              any_value(sector) AS sector, any_value(industry) AS industry,
              count(m.article_id) AS n_articles
       FROM (SELECT * FROM e WHERE rn4 = 1) e LEFT JOIN (SELECT * FROM m WHERE rn3 = 1) m
         ON e.company_id = m.company_id AND e.breach_date < m.article_date
         AND date_diff('day', e.breach_date, m.article_date) < {MAX_DAYS}
       GROUP BY e.breach_id""",
    ("articles_v", "companies_v", "breaches_v"),
)
def c03(spark, d):
    covered = P.event_coverage(
        articles(spark, d), companies(spark, d), breaches(spark, d), MAX_DAYS
    )
    return covered.select(
        "breach_id", "organisation", "breach_date", "sector", "industry", "n_articles"
    )


@query(
    "c04_representation_report",
    f"""WITH {SHARES_SQL},
        r AS (SELECT CASE WHEN percentage_all < 4 THEN 'Other' ELSE publication END AS publication,
                     sum(count_all) AS ca, sum(percentage_all) AS pa, sum(percentage_breach) AS pb,
                     sum(count_breach) AS cb FROM p GROUP BY 1),
        z AS (SELECT *, sqrt(pa / 100 * (1 - pa / 100) / (SELECT sum(cb) FROM r)) AS se FROM r)
        SELECT publication, CAST(ca AS BIGINT) AS count_all, round(pa, 6) AS percentage_all,
               CAST(cb AS BIGINT) AS count_part, round(pb, 6) AS percentage_part,
               round((pb - pa) / 100 / se, 6) AS z_score,
               (SELECT round(sum(pow(cb - ca * t.cb_all / t.ca_all, 2) / (ca * t.cb_all / t.ca_all)), 6)
                FROM r JOIN (SELECT sum(cb) AS cb_all, sum(ca) AS ca_all FROM r) t ON true) AS chi_square
        FROM z""",
    ("articles_v",),
)
def c04(spark, d):
    rows = articles(spark, d).select("publication", "label")
    report = P.representation_report(rows, "publication", is_breach(), threshold=4, with_p=False)
    return rounded(
        report.drop("standard_error"), "percentage_all", "percentage_part", "z_score", "chi_square"
    )


@query(
    "c05_labelled_prompt_set",
    """WITH v AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS embedding, label, source, lang
                  FROM embeddings JOIN documents ON doc_id = vec_id),
            u AS (SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM v),
            b AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM u GROUP BY pos),
            p AS (SELECT i, list(lo + (hi - lo) * (i / 199.0::DOUBLE) ORDER BY pos) AS point
                  FROM b JOIN range(200) t(i) ON true GROUP BY i),
            s AS (SELECT DISTINCT doc_id FROM (
                    SELECT v.doc_id, row_number() OVER (PARTITION BY i
                      ORDER BY list_distance(point, v.embedding), v.doc_id) AS rn
                    FROM p JOIN v ON true) WHERE rn = 1),
            n AS (SELECT q.doc_id, e.source, e.lang, e.label, row_number() OVER (
                    PARTITION BY q.doc_id ORDER BY list_distance(q.embedding, e.embedding), e.doc_id) AS rank
                  FROM (SELECT v.* FROM v JOIN s USING (doc_id)) q
                  JOIN (SELECT * FROM v WHERE doc_id IN (SELECT doc_id FROM labels)) e ON true QUALIFY rank <= 6),
            x AS (SELECT doc_id, string_agg('Source : ' || source || chr(10) || 'Lang : ' || lang || chr(10)
                           || 'Label : ' || label, chr(10) || chr(10) ORDER BY rank) AS examples
                  FROM n GROUP BY doc_id)
       SELECT doc_id, 'Label it.' || chr(10) || chr(10)
          || 'Your answer should follow the format given in the examples:' || chr(10) || chr(10) || chr(10)
          || examples || chr(10) || chr(10) || 'Now classify the following: ' || chr(10)
          || 'Source : ' || source || chr(10) || 'Lang : ' || lang AS prompt
       FROM x JOIN v USING (doc_id)""",
)
def c05(spark, d):
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    rows = table(spark, d, "documents").select("doc_id", "lang", "source").join(vectors, "doc_id")
    block = lines_of({"Source": "source", "Lang": "lang", "Label": "label"}).alias("block")
    labelled = rows.join(table(spark, d, "labels"), "doc_id", "left_semi")
    examples = labelled.select(F.col("doc_id").alias("example_id"), "embedding", block)
    prompts = P.labelled_prompt_set(
        rows, examples, "doc_id", "example_id", "embedding", "block",
        {"Source": "source", "Lang": "lang"}, "Label it.",
    )
    return prompts.select("doc_id", "prompt")


@query(
    "c06_event_and_org_filter",
    """SELECT publication, count(*) AS count FROM (
         SELECT *, row_number() OVER (PARTITION BY headline ORDER BY page_id) AS rn FROM (
           SELECT page_id, headline, publication,
                  CASE WHEN length(headline) > 60 THEN NULL ELSE 'True' END AS breach,
                  CASE WHEN length(headline) > 20 THEN split_part(headline, ' ', 1)
                       ELSE 'government' END AS company FROM headlines_v))
       WHERE rn = 1 AND breach IS NOT NULL AND company <> 'government'
       GROUP BY publication""",
    ("headlines_v",),
)
def c06(spark, d):
    size = F.length("headline")
    rows = headlines(spark, d).select(
        "page_id", "headline", "publication",
        F.when(size <= 60, "True").alias("breach"),
        F.when(size > 20, F.split("headline", " ")[0]).otherwise("government").alias("company"),
    )
    return P.event_and_org_filter(rows, "headline", ["page_id"], "breach", "company", "publication")
