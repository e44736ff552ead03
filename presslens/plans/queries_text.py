"""X: HTML, prompts, replies, scoring; N: nested values; Q: streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions.text import BREACH_KEYWORDS
from presslens.operators import html as H, labelling as L, nested as N
from presslens.operators.agreement import multilabel_metrics
from presslens.operators.classifier import train_text_classifier
from presslens.operators.ranking import train_test_split
from presslens.plans.registry import query
from presslens.plans.views import headlines, table
from presslens.sources.storage import scratch_path
from presslens.streaming.label_stream import label_stream

# Rules for the hosts of the page table; one host family is left without a rule.
PAGE_RULES = [
    ("example.com", ("tag", "equals", "article"), [("tag", "equals", "p")]),
    ("example.net", ("tag", "equals", "article"), [("tag", "equals", "p"), ("tag", "equals", "h1")]),
]


# Tags, comments, scripts and styles become breaks, breaks one blank; then the entities that
# occur in the pages are read.
TEXT_SQL = r"""regexp_replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace({0},
      '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[a-z/!][^>]*>', chr(1), 'g'),
      '\s*(' || chr(1) || '\s*)+', ' ', 'g'), '^\s+|\s+$', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'),
    '&amp;?', '&', 'g')"""
SITE_SQL = "regexp_extract(url, '^https?://(?:[^/?#]*[.])?([a-z]+[.][a-z]+)', 1)"


@query("x01_html_to_text", f"SELECT page_id, {TEXT_SQL.format('html')} AS text FROM pages")
def x01(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    return H.html_to_text(pages, "html").select("page_id", "text")


# In these pages an article holds a heading and paragraphs only.
@query(
    "x02_extract_article",
    f"""SELECT page_id, site, CASE site WHEN 'example.com' THEN {TEXT_SQL.format("regexp_replace(body, '(?is)<h1>.*?</h1>', '')")}
                WHEN 'example.net' THEN {TEXT_SQL.format("body")} END AS article_text,
              CASE WHEN site NOT IN ('example.com', 'example.net') THEN 'no rule for ' || site END AS error
        FROM (SELECT page_id, {SITE_SQL} AS site,
                     regexp_extract(html, '(?is)<article>(.*)</article>', 1) AS body FROM pages)""",
)
def x02(spark, d):
    site = F.regexp_extract("url", r"^https?://(?:[^/?#]*[.])?([a-z]+[.][a-z]+)", 1)
    pages = table(spark, d, "pages").select("page_id", site.alias("site"), "html")
    return H.extract_article(pages, "html", "site", PAGE_RULES).drop("html")


# The shipped sites, and two without a rule, dealt over the pages; each page gets the marks that
# its site's rule looks for. Of the cnn pages the heading is text as well, and the new york times
# has a second container behind the first.
SHIPPED = [name for name, *_ in H.SITE_RULES] + ["the daily example", "example herald"]
MARKS = {
    "new york times": ("div", 'data-testid="companionColumn-0"'),
    "cnn": ("div", 'class="wide storyTD"'),
    "fox": ("div", 'class="article-wrap has-video"'),
    "washington post": ("div", 'class="grid-center"'),
    "daily mail": ("div", 'itemprop="articleBody"'),
    "cnbc": ("div", 'class="ArticleBody-articleBody"'),
    "the guardian": ("div", 'id="maincontent"'),
    "new york post": ("div", 'class="layout layout__inner"'),
    "bbc": ("div", 'id="main"'),
    "usa today": ("div", 'class="gnt_pr"'),
}
SECOND_COLUMN = '<div data-testid="companionColumn-1"><p>More in this section</p>and an advertisement</div>'


def _marked_pages(spark, d):
    site = F.element_at(F.array(*(F.lit(s) for s in SHIPPED)), (F.col("page_id") % len(SHIPPED) + 1).cast("int"))
    pages = table(spark, d, "pages").select("page_id", site.alias("site"), "html")
    page = F.col("html")
    for name, (tag, mark) in MARKS.items():
        own = F.replace(F.replace("html", F.lit("<article>"), F.lit(f"<{tag} {mark}>")), F.lit("</article>"), F.lit(f"</{tag}>"))
        if name == "bbc":
            own = F.replace(own, F.lit("<p>"), F.lit('<p data-component="text-block">'))
        if name == "cnn":
            own = F.replace(own, F.lit("<h1>"), F.lit('<h1 class="inStoryHeading2">'))
        if name == "new york times":
            own = F.replace(own, F.lit("<footer>"), F.lit(SECOND_COLUMN + "<footer>"))
        page = F.when(F.col("site") == name, own).otherwise(page)
    return pages.withColumn("html", page)


@query(
    "x02_extract_by_shipped_rules",
    f"""SELECT page_id, site,
              CASE WHEN site IN ({", ".join(f"'{s}'" for s in MARKS)}) THEN trim(
                CASE site WHEN 'cnn' THEN {TEXT_SQL.format("body")}
                ELSE {TEXT_SQL.format("regexp_replace(body, '(?is)<h1>.*?</h1>', '')")} END
                || CASE site WHEN 'new york times' THEN ' More in this section' ELSE '' END) END AS article_text,
              CASE WHEN site NOT IN ({", ".join(f"'{s}'" for s in MARKS)}) THEN 'no rule for ' || site END AS error
        FROM (SELECT page_id, [{", ".join(f"'{s}'" for s in SHIPPED)}][page_id % {len(SHIPPED)} + 1] AS site,
                     regexp_extract(html, '(?is)<article>(.*)</article>', 1) AS body FROM pages)""",
)
def x02_shipped(spark, d):
    """Article text by the rules that come with the operator."""
    return H.extract_article(_marked_pages(spark, d), "html", "site").drop("html")


def _embedded(spark, d):
    """Documents with a vector and the label of its cluster."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(vectors, "doc_id")


def _examples(spark, d, rows):
    """Prompt blocks of the documents that the labels cover."""
    block = L.lines_of({"Source": "source", "Lang": "lang", "Label": "label"})
    labelled = rows.join(table(spark, d, "labels"), "doc_id", "left_semi")
    return labelled.select(F.col("doc_id").alias("example_id"), "embedding", block.alias("block"))


NEAR_SQL = """near AS (
    SELECT q.doc_id, e.doc_id AS example_id,
           row_number() OVER (PARTITION BY q.doc_id ORDER BY list_distance(
             q.embedding::DOUBLE[], e.embedding::DOUBLE[]), e.doc_id) AS rank
    FROM (SELECT vec_id AS doc_id, embedding FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)) q
    JOIN (SELECT vec_id AS doc_id, embedding FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)
          AND vec_id IN (SELECT doc_id FROM documents)) e ON true
    QUALIFY rank <= 6),
  blocks AS (SELECT n.doc_id, string_agg('Source : ' || source || chr(10) || 'Lang : ' || lang ||
               chr(10) || 'Label : ' || label, chr(10) || chr(10) ORDER BY rank) AS examples
             FROM near n JOIN documents s ON s.doc_id = n.example_id
             JOIN embeddings v ON v.vec_id = n.example_id GROUP BY n.doc_id)"""


@query(
    "x03_build_prompt",
    f"""WITH {NEAR_SQL}
        SELECT doc_id, 'Is this about a breach?' || chr(10) || chr(10) ||
          'Your answer should follow the format given in the examples:' || chr(10) || chr(10) || chr(10)
          || examples || chr(10) || chr(10) || 'Now classify the following: ' || chr(10)
          || 'Source : ' || source || chr(10) || 'Lang : ' || lang AS prompt
        FROM blocks JOIN documents USING (doc_id)""",
)
def x03(spark, d):
    rows = _embedded(spark, d)
    chosen = L.select_examples(rows, _examples(spark, d, rows), "doc_id", "example_id", "embedding", "block")
    prompts = L.build_prompt(
        chosen, "Is this about a breach?", "examples", {"Source": "source", "Lang": "lang"}
    )
    return prompts.select("doc_id", "prompt")


@query(
    "x03_build_fragment",
    """SELECT doc_id, '<s>Classify: source: ' || source || chr(10) || 'lang: ' || lang || ' ###> '
              || 'n_chars : ' || n_chars || '</s>' AS fragment FROM documents""",
)
def x03_fragment(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    fragments = L.build_fragment(
        docs, "Classify: ", {"source": "source", "lang": "lang"}, {"n_chars": "n_chars"}
    )
    return fragments.select("doc_id", "fragment")


@query(
    "x04_select_examples",
    f"WITH {NEAR_SQL} SELECT doc_id, examples FROM blocks",
)
def x04(spark, d):
    rows = _embedded(spark, d)
    chosen = L.select_examples(rows, _examples(spark, d, rows), "doc_id", "example_id", "embedding", "block")
    return chosen.select("doc_id", F.array_join("examples", "\n\n").alias("examples"))


def _replies(spark, d):
    """A reply per turn in the shape of a model answer, with a repeated and a stray key."""
    reply = F.concat(
        F.lit("prompt ###> BreachMentioned : "), F.when(F.col("role") == "user", "True").otherwise("no"),
        F.lit("\n CompanyMentioned: A: "), F.col("role"),
        F.lit("\nBreachMentioned : False\nno colon here\nfoo : "), F.col("text"),
    )
    return table(spark, d, "conversations").select("conv_id", "turn", reply.alias("reply"))


@query(
    "x05_parse_response",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'True' ELSE 'no' END AS BreachMentioned,
              'A: ' || role AS CompanyMentioned, CAST(NULL AS VARCHAR) AS Severity
       FROM conversations""",
)
def x05(spark, d):
    keys = ["BreachMentioned", "CompanyMentioned", "Severity"]
    return L.parse_response(_replies(spark, d), "reply", keys, cut_before="###>").drop("reply")


@query(
    "x05_parse_blocks",
    """SELECT conv_id, turn, CAST(block AS INTEGER) AS block,
              CASE block WHEN 0 THEN role ELSE '' END AS Role,
              CASE block WHEN 1 THEN CAST(turn AS VARCHAR) ELSE '' END AS Turn_no
       FROM conversations JOIN (VALUES (0), (1)) b(block) ON true""",
)
def x05_blocks(spark, d):
    text = F.concat(
        F.lit("ROLE : x\nrole: "), F.col("role"), F.lit("\n\n"), F.lit("Turn_No : "), F.col("turn").cast("string")
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", text.alias("reply"))
    parsed = L.parse_blocks(turns, "reply", ["Role", "Turn_no"])
    return parsed.na.fill("", ["Role", "Turn_no"]).drop("reply")


@query(
    "x06_validate_labels",
    r"""SELECT conv_id, turn, role = 'user' AND regexp_matches(text, '^\p{L}{3,}') AS valid
        FROM conversations""",
)
def x06(spark, d):
    turns = table(spark, d, "conversations").select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", " TRUE ").otherwise(F.col("role")).alias("breach"),
        F.col("text").alias("company"),
    )
    checked = L.validate_labels(
        turns, {"company": r"\p{L}{3,}[\s\S]*"}, {"breach": {"true", "false"}}
    )
    return checked.select("conv_id", "turn", "valid")


WORDS = (*BREACH_KEYWORDS, "licen", "password")
SCORED_SQL = r"""SELECT doc_id,
  regexp_matches(text, '(?i)(\s|^)(breach|data|hack|record|leak|licen|password)') AS label FROM documents"""


@query("x07_score_in_batches", SCORED_SQL)
def x07(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return L.score_in_batches(docs, "text", words=WORDS).select("doc_id", "label")


@query("x07_score_with_batch_scorer", SCORED_SQL)
def x07_batches(spark, d):
    pattern = r"(?i)(?:\s|^)(?:" + "|".join(WORDS) + ")"
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = L.score_in_batches(docs, "text", lambda texts: texts.str.contains(pattern))
    return scored.select("doc_id", "label")


@query(
    "x08_attach_predictions",
    f"""SELECT doc_id, lang, label AS breach, n_chars > 500 AS company FROM documents
        JOIN ({SCORED_SQL}) USING (doc_id)""",
)
def x08(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text", "n_chars")
    scored = L.score_in_batches(docs, "text", words=WORDS, out="breach")
    scored = scored.withColumn("company", F.col("n_chars") > 500)
    return L.attach_predictions(
        docs.select("doc_id", "lang"), scored, ["doc_id"], ["breach", "company"]
    )


@query("x09_train_text_classifier")
def x09(spark, d):
    """Held-out scores of two labels learnt on vectors; the solver decides the digits."""
    rows = table(spark, d, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 5).alias("low"),
        F.col("label").isin(0, 3, 6, 9).alias("third"),
    )
    train, test = train_test_split(rows, ["vec_id"], 0.8)
    model = train_text_classifier(train, ["low", "third"], vector="embedding")
    scored = model.predict(test)
    truth = F.array(F.col("low").cast("int"), F.col("third").cast("int"))
    guess = F.array(F.col("low_pred").cast("int"), F.col("third_pred").cast("int"))
    return multilabel_metrics(scored.select(truth.alias("t"), guess.alias("p")), "t", "p")


@query("x09_train_on_words")
def x09_words(spark, d):
    """Held-out scores of both labels of documents, learnt on their words; the solver decides the digits."""
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    rows = table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")
    rows = rows.select("doc_id", "text", (F.col("q") == 1).alias("quality"), (F.col("t") == 1).alias("toxic"))
    train, test = train_test_split(rows, ["doc_id"], 0.8)
    model = train_text_classifier(train, ["quality", "toxic"], text="text")
    scored = model.predict(test)
    truth = F.array(F.col("quality").cast("int"), F.col("toxic").cast("int"))
    guess = F.array(F.col("quality_pred").cast("int"), F.col("toxic_pred").cast("int"))
    return multilabel_metrics(scored.select(truth.alias("t"), guess.alias("p")), "t", "p")


@query(
    "n01_group_by_nested",
    """SELECT '{"k":' || CAST(k AS VARCHAR) || ',"kind":"' || event_type || '"}' AS nested_key,
              count(*) AS count
       FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
       GROUP BY 1""",
)
def n01(spark, d):
    k = F.get_json_object("props", "$.k")
    kind = F.concat(F.lit('"kind": "'), F.col("event_type"), F.lit('"'))
    # Half of the objects name their fields in the other order.
    text = F.when(
        F.col("value") > 20, F.concat(F.lit("{"), kind, F.lit(', "k": '), k, F.lit("}"))
    ).otherwise(F.concat(F.lit('{"k": '), k, F.lit(","), kind, F.lit("}")))
    return N.group_by_nested(table(spark, d, "events").select(text.alias("nested")), "nested")


@query(
    "n02_add_json_field",
    """SELECT event_id, '{"k":' || k || ',"orgType":"' ||
              CASE k WHEN '7' THEN 'Retail' WHEN '42' THEN 'Finance' ELSE 'others' END || '"}' AS props
       FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)""",
)
def n02(spark, d):
    events = table(spark, d, "events").select("event_id", "props")
    return N.add_json_field(
        events, "props", "k bigint", "k", "orgType", {"7": "Retail", "42": "Finance"}
    )


@query(
    "q01_label_stream",
    r"""SELECT DISTINCT headline,
          regexp_matches(headline, '(?i)(\s|^)(breach|data|hack|record|leak|the)') AS label
        FROM headlines_v""",
    ("headlines_v",),
)
def q01(spark, d):
    """Two arrivals of the same headlines, one run each, into one table."""
    source, target = scratch_path(spark, "arrivals"), scratch_path(spark, "labelled")
    checkpoint = scratch_path(spark, "stream-state")
    arrivals = headlines(spark, d).select(
        "headline", F.timestamp_seconds(F.lit(1_700_000_000)).alias("arrived")
    )
    words = "|".join((*BREACH_KEYWORDS, "the"))
    pattern = rf"(?i)(?:\s|^)(?:{words})"
    for _ in range(2):
        arrivals.write.mode("append").parquet(source)
        run = label_stream(
            spark, source, target, checkpoint, arrivals.schema, "headline", ["headline"],
            "arrived", "7 days", lambda texts: texts.str.contains(pattern),
        )
        run.awaitTermination()
    return spark.read.parquet(target).select("headline", "label")
