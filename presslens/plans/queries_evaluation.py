"""E: rater agreement and classifier scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import agreement as E
from presslens.operators.joins import align_raters
from presslens.plans.queries_aggregates import rounded
from presslens.plans.registry import query
from presslens.plans.views import rater_a, rater_b, table

LABELS = ["quality", "toxic"]
VALUES = ["false", "true"]
RATERS = ("rater_a", "rater_b")


def aligned(spark, d):
    raters = {"a": rater_a(spark, d), "b": rater_b(spark, d)}
    return align_raters(raters, ["doc_id"], LABELS)


# Documents without a label have one rating and are topped up on the last label.
@query(
    "e01_fleiss_pivot",
    """WITH v AS (SELECT doc_id, quality FROM rater_a UNION ALL SELECT doc_id, quality FROM rater_b),
            c AS (SELECT doc_id, count(*) FILTER (NOT quality) AS f,
                         count(*) FILTER (quality) AS t FROM v GROUP BY 1)
       SELECT doc_id, f AS "false", t + (SELECT max(f + t) FROM c) - f - t AS "true" FROM c""",
    RATERS,
)
def e01(spark, d):
    raters = [rater_a(spark, d), rater_b(spark, d)]
    return E.fleiss_pivot(raters, ["doc_id"], "quality", VALUES)


KAPPA_SQL = """SELECT round((avg(p) - e) / (1 - e), 9) AS kappa FROM (
    SELECT (f * (f - 1) + t * (t - 1)) / 2 AS p,
           pow(sum(f) OVER () / (2 * count(*) OVER ()), 2)
           + pow(sum(t) OVER () / (2 * count(*) OVER ()), 2) AS e
    FROM (SELECT CAST(NOT a.{0} AS INTEGER) + CAST(NOT b.{0} AS INTEGER) AS f,
                 CAST(a.{0} AS INTEGER) + CAST(b.{0} AS INTEGER) AS t
          FROM rater_a a JOIN rater_b b USING (doc_id))) GROUP BY e"""


def _kappa(spark, d, label):
    both = aligned(spark, d)
    raters = [both.select("doc_id", F.col(f"{label}_{r}").alias(label)) for r in ("a", "b")]
    return E.fleiss_kappa(E.fleiss_pivot(raters, ["doc_id"], label, VALUES), VALUES)


@query("e02_fleiss_kappa", KAPPA_SQL.format("quality"), RATERS)
def e02(spark, d):
    return rounded(_kappa(spark, d, "quality"), "kappa", digits=9)


REPORT_SQL = """j AS (SELECT a.quality AS t, b.quality AS p FROM rater_a a JOIN rater_b b USING (doc_id)),
    c AS (SELECT l, count(*) FILTER (t = l AND p = l) AS tp, count(*) FILTER (p = l) AS np,
                 count(*) FILTER (t = l) AS nt FROM j JOIN (VALUES (true), (false)) v(l) ON true
          GROUP BY l),
    s AS (SELECT CAST(l AS VARCHAR) AS label, tp / np AS precision, tp / nt AS recall,
                 2 * tp / (np + nt) AS f1, nt AS support FROM c)"""


@query(
    "e03_classification_report",
    f"""WITH {REPORT_SQL},
        r AS (SELECT * FROM s UNION ALL
          SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM s UNION ALL
          SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                 sum(support) FROM s)
        SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM r""",
    RATERS,
)
def e03(spark, d):
    report = E.classification_report(aligned(spark, d), "quality_a", "quality_b")
    return rounded(report, "precision", "recall", "f1", digits=9)


METRICS_SQL = """u AS (SELECT 'quality' AS label, a.quality AS a, b.quality AS b
                       FROM rater_a a JOIN rater_b b USING (doc_id) UNION ALL
                       SELECT 'toxic', a.toxic, b.toxic FROM rater_a a JOIN rater_b b USING (doc_id)),
    k AS (SELECT label, count(*) AS n, count(*) FILTER (a AND b) AS tp, count(*) FILTER (a) AS pa,
                 count(*) FILTER (b) AS pb, count(*) FILTER (a = b) AS agree FROM u GROUP BY 1),
    q AS (SELECT *, pow((pa + pb) / (2 * n), 2) + pow(1 - (pa + pb) / (2 * n), 2) AS e FROM k),
    m AS (SELECT label, (agree / n - e) / (1 - e) AS kappa, coalesce(tp / nullif(pb, 0), 0) AS precision,
                 coalesce(tp / nullif(pa, 0), 0) AS recall,
                 coalesce(2 * tp / nullif(pa + pb, 0), 0) AS f1,
                 greatest(pa, pb) AS support, agree, n - agree AS disagree FROM q)"""


@query(
    "e04_label_metrics",
    f"""WITH {METRICS_SQL} SELECT label, round(kappa, 9) AS kappa, round(precision, 9) AS precision,
        round(recall, 9) AS recall, round(f1, 9) AS f1, support, agree, disagree FROM m""",
    RATERS,
)
def e04(spark, d):
    metrics = E.label_metrics(aligned(spark, d), LABELS, "a", "b")
    return rounded(metrics, "kappa", "precision", "recall", "f1", digits=9)


@query(
    "e05_overall_scores",
    f"""WITH {REPORT_SQL}, {METRICS_SQL},
        x AS (SELECT (SELECT avg(f1) FROM s) AS cf, (SELECT kappa FROM m WHERE label = 'quality') AS ck,
                     avg(f1) AS lf, avg(kappa) AS lk FROM m)
        SELECT round(cf, 9) AS category_f1, round(ck, 9) AS category_irr, round(lf, 9) AS labels_f1,
               round(lk, 9) AS labels_irr, round((2 * cf + 2 * lf) / 4, 9) AS overall_f1,
               round((2 * ck + 2 * lk) / 4, 9) AS overall_irr FROM x""",
    RATERS,
)
def e05(spark, d):
    both = aligned(spark, d)
    scores = E.overall_scores(
        E.classification_report(both, "quality_a", "quality_b"),
        _kappa(spark, d, "quality"),
        E.label_metrics(both, LABELS, "a", "b"),
        len(LABELS),
    )
    return rounded(scores, *scores.columns, digits=9)


@query(
    "e06_disagreements",
    """SELECT doc_id, a.quality AS quality_a, b.quality AS quality_b, a.toxic AS toxic_a,
              b.toxic AS toxic_b FROM rater_a a JOIN rater_b b USING (doc_id)
       WHERE a.quality <> b.quality OR a.toxic <> b.toxic""",
    RATERS,
)
def e06(spark, d):
    return E.disagreements(aligned(spark, d), LABELS, "a", "b")


def _documents_rated(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    size = F.when(F.col("n_chars") <= 1000, "small").when(F.col("n_chars") <= 5000, "medium")
    return aligned(spark, d).join(docs, "doc_id").withColumn("size", size.otherwise("large"))


@query(
    "e07_metrics_by_group",
    """SELECT source, round(coalesce(2 * tp / nullif(np + nt, 0), 0), 9) AS f1,
              round(ok / n, 9) AS accuracy, n FROM (
         SELECT source, count(*) AS n, count(*) FILTER (a.quality AND b.quality) AS tp,
                count(*) FILTER (b.quality) AS np, count(*) FILTER (a.quality) AS nt,
                count(*) FILTER (a.quality = b.quality) AS ok
         FROM rater_a a JOIN rater_b b USING (doc_id) JOIN documents USING (doc_id) GROUP BY 1)""",
    RATERS,
)
def e07(spark, d):
    metrics = E.metrics_by_group(
        _documents_rated(spark, d), {"source": None}, "quality_a", "quality_b"
    )
    return rounded(metrics, "f1", "accuracy", digits=9)


@query(
    "e07_metrics_grid",
    """WITH j AS (SELECT lang, CASE WHEN n_chars <= 1000 THEN 'small' WHEN n_chars <= 5000
                           THEN 'medium' ELSE 'large' END AS size, a.quality AS a, b.quality AS b
                  FROM rater_a a JOIN rater_b b USING (doc_id) JOIN documents USING (doc_id)),
            g AS (SELECT lang, size FROM (SELECT DISTINCT lang FROM j)
                  JOIN (VALUES ('small'), ('medium'), ('large'), ('huge')) v(size) ON true)
       SELECT lang, size,
              round(CASE WHEN count(a) > 0 THEN coalesce(2 * count(*) FILTER (a AND b)
                / nullif(count(*) FILTER (a) + count(*) FILTER (b), 0), 0) END, 9) AS f1,
              round(count(*) FILTER (a = b) / nullif(count(a), 0), 9) AS accuracy, count(a) AS n
       FROM g LEFT JOIN j USING (lang, size) GROUP BY ALL""",
    RATERS,
)
def e07_grid(spark, d):
    metrics = E.metrics_by_group(
        _documents_rated(spark, d),
        {"lang": None, "size": ["small", "medium", "large", "huge"]},
        "quality_a",
        "quality_b",
    )
    return rounded(metrics, "f1", "accuracy", digits=9)


@query(
    "e08_multilabel_metrics",
    f"""WITH {METRICS_SQL}
        SELECT round(2 * sum(tp) / (sum(pa) + sum(pb)), 9) AS micro_f1,
          round(sum(coalesce(tp / nullif(pb, 0), 0) * pa) / sum(pa), 9) AS weighted_precision,
          round(sum(coalesce(tp / nullif(pa, 0), 0) * pa) / sum(pa), 9) AS weighted_recall,
          round(sum(coalesce(2 * tp / nullif(pa + pb, 0), 0) * pa) / sum(pa), 9) AS weighted_f1,
          round((SELECT avg(CAST(a.quality = b.quality AND a.toxic = b.toxic AS INTEGER))
                 FROM rater_a a JOIN rater_b b USING (doc_id)), 9) AS subset_accuracy
        FROM q""",
    RATERS,
)
def e08(spark, d):
    arrays = aligned(spark, d).select(
        *(
            F.array(*(F.col(f"{v}_{r}").cast("int") for v in LABELS)).alias(name)
            for r, name in (("a", "truth"), ("b", "predicted"))
        )
    )
    scores = E.multilabel_metrics(arrays, "truth", "predicted")
    return rounded(scores, *scores.columns, digits=9)
