"""Readers, writers, HTML and the stream on small files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from presslens.operators import html, labelling
from presslens.operators.aggregates import usage_totals
from presslens.sources import readers, sinks, vector_table
from presslens.sources.storage import scratch_path, storage_root
from presslens.streaming.label_stream import label_stream


def test_latin1_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('name,note\n"Café ""X""","two\nlines"\n'.encode("latin-1"))
    got = readers.read_csv_typed(
        spark, str(path), "name string, note string", "ISO-8859-1", multi_line=True
    ).first()
    assert (got.name, got.note) == ('Café "X"', "two\nlines")


def test_first_data_rows_are_skipped_in_file_order(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id\n" + "".join(f"{9 - i}\n" for i in range(10)))
    got = readers.read_csv_skipping(spark, str(path), "id long", 3)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_json_list_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"domain": "a.com"}, {"domain": "b.org"}], indent=2))
    got = readers.read_json_array(spark, str(path), "domain string")
    assert sorted(r.domain for r in got.collect()) == ["a.com", "b.org"]


def test_item_files_by_kind(spark, tmp_path):
    for name in ("RS_1.jsonl", "RC_1.jsonl", "other.jsonl"):
        (tmp_path / name).write_text(json.dumps({"id": name}) + "\n")
    count = lambda kind: readers.read_jsonl_glob(spark, str(tmp_path), "id string", kind).count()
    assert (count("all"), count("posts"), count("comments")) == (2, 1, 1)
    with pytest.raises(NotImplementedError):
        count("none")


def test_files_hold_at_most_n_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_max_rows(spark.range(95).coalesce(1), path, 10)
    per_file = readers.read_folder_union(spark, path, "id long").groupBy("source_file").count()
    assert per_file.agg(F.max("count"), F.count("*")).first()[:] == (10, 10)


def test_run_log_appends_one_line_per_run(spark, tmp_path):
    path = str(tmp_path / "log")
    usage = usage_totals(spark.createDataFrame([("a b", "c")], "p string, r string"), "p", "r", 1.0, 2.0)
    for _ in range(2):
        sinks.append_run_log(spark, path, usage, 3.0, dt.datetime(2024, 5, 6, 7, 8))
    lines = spark.read.json(path).collect()
    assert len(lines) == 2
    assert (lines[0].date, lines[0].time, lines[0].tokens_prompted, lines[0].run_cost_usd) == (
        "2024-05-06", "07:08", 2, 0.004)


def test_newest_vector_wins_and_survives_compaction(spark, tmp_path):
    path, target = str(tmp_path / "v"), str(tmp_path / "c")
    schema = "id string, document string, embedding array<float>"
    vector_table.upsert(spark.createDataFrame([("a", "x", [1.0]), ("b", "y", [2.0])], schema), path, 1)
    vector_table.upsert(spark.createDataFrame([("a", "z", [3.0])], schema), path, 2)
    vector_table.compact(spark, path, target)
    got = {r.id: r.document for r in spark.read.parquet(target).collect()}
    assert got == {"a": "z", "b": "y"}


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<p>outside</p><div id="maincontent"><p>One &amp; <b>two<p>three</p><div>no <span>text</span></div>
<!-- note --><p>four</p></div><p>after</p></body></html>"""


def test_page_text_without_scripts_and_comments(spark):
    df = spark.createDataFrame([(PAGE,), (None,)], "html string")
    got = [r.text for r in html.html_to_text(df, "html").collect()]
    assert got == ["T outside One & two three no text four after", None]


def test_article_rules(spark):
    nyt = '<div><i data-testid="companionColumn-0"><p>a</p>x</i><i data-testid="companionColumn-1"><p>b</p></i></div>'
    bbc = '<html><div data-component="text-block">t<b>u</b></div><p>no</p></html>'
    cnn = '<td class="x storyTD"><p>p1</p><span class="inStoryHeading2">h</span>z</td>'
    pages = [("The Guardian", PAGE), ("New York Times", nyt), ("BBC", bbc), ("CNN", cnn),
             ("Unknown", PAGE), ("Fox", PAGE)]
    df = spark.createDataFrame(pages, "site string, html string")
    got = {r.site: (r.article_text, r.error) for r in html.extract_article(df, "html", "site").collect()}
    assert got["The Guardian"] == ("One & two three four", None)
    assert got["New York Times"] == ("a b", None)
    assert got["BBC"] == ("t u", None)
    assert got["CNN"] == ("p1 h", None)
    assert got["Unknown"] == (None, "no rule for Unknown")
    assert got["Fox"] == (None, "container not found")


def test_stream_labels_each_headline_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    for batch in (["data leak", "cookies"], ["cookies", "hacked"]):
        spark.createDataFrame([(h,) for h in batch], "h string").withColumn("at", at).write.mode(
            "append").parquet(source)
        schema = spark.read.parquet(source).schema
        label_stream(spark, source, target, state, schema, "h", ["h"], "at").awaitTermination()
    got = sorted((r.h, r.label) for r in spark.read.parquet(target).collect())
    assert got == [("cookies", False), ("data leak", True), ("hacked", True)]


def test_scratch_lies_under_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert storage_root(spark) == root.rstrip("/")
    assert scratch_path(spark, "x").startswith(storage_root(spark))


def test_write_by_key_makes_few_files(spark, tmp_path):
    keys = F.when(F.col("id") % 3 == 0, "hot/key").when(F.col("id") % 50 == 1, None)
    df = spark.range(20_000, numPartitions=40).withColumn("name", keys.otherwise(F.concat(F.lit("k"), F.col("id") % 7)))
    path = str(tmp_path / "by_key")
    sinks.write_by_key(df, path, "name")
    folders = [p for p in (tmp_path / "by_key").iterdir() if p.is_dir()]
    assert len(folders) == 9 and sum(len(list(p.glob("*.parquet"))) for p in folders) <= 18
    back = spark.read.parquet(path).select("id", "name")
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    sinks.write_by_key(df.limit(0), path + "-none", "name")


def test_skipped_rows_of_a_file_read_in_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("id,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        for n in (0, 1, 5_000, 19_999, 20_000, 30_000):
            got = readers.read_csv_skipping(spark, str(path), "id long, pad string", n)
            assert got.columns == ["id", "pad"] and (n > 20_000 or got.rdd.getNumPartitions() > 1 or n == 20_000)
            assert sorted(r.id for r in got.collect()) == list(range(n, 20_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_breaks_are_skipped_as_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note\n1,"two\nlines"\n2,x\n3,y\n')
    got = readers.read_csv_skipping(spark, str(path), "id long, note string", 1, multi_line=True)
    assert [(r.id, r.note) for r in got.collect()] == [(2, "x"), (3, "y")]


def test_newest_vectors_with_ties_and_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id string, document string, embedding array<double>"
    vector_table.upsert(spark.createDataFrame([("a", "x", [1.0]), (None, "n", None), ("c", "c", [4.0])], schema), path, 1)
    vector_table.upsert(spark.createDataFrame([("a", "z", [3.0]), ("a", "y", [5.0]), (None, "m", [2.0])], schema), path, 2)
    vector_table.upsert(spark.createDataFrame([("a", "y", [5.0])], schema), path, 2)
    got = sorted(map(tuple, vector_table.scan(spark, path).collect()), key=str)
    assert got == [("a", "y", [5.0], 2), ("c", "c", [4.0], 1), (None, "m", [2.0], 2)]
    plan = vector_table.scan(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_extraction_and_scoring_keep_columns_of_any_type(spark):
    df = spark.createDataFrame([("BBC", "<html><p data-component='text-block'>t</p></html>"), (None, None)], "site string, page string")
    df = df.withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))
    got = html.extract_article(df, "page", "site").collect()
    assert [(r.article_text, r.error, r.extra) for r in got] == [("t", None, {"k": 1}), (None, "no rule for None", {"k": 1})]
    again = html.extract_article(html.extract_article(df, "page", "site"), "page", "site")
    assert again.columns == ["site", "page", "extra", "article_text", "error"]
    scored = labelling.score_in_batches(df, "page", lambda texts: texts.str.len(), "n", "long")
    assert [(r.n, r.extra) for r in scored.collect()] == [(49, {"k": 1}), (None, {"k": 1})]
    plan = scored.select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plan = html.extract_article(df, "page", "site")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
