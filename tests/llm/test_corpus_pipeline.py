"""The pipeline's stages and the registered corpus queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if n.startswith("op")])
def test_query_matches_sql(spark, name):
    result = compare(spark, FOLDER, name, entry.queries()[name], ORACLES[name])
    assert result["status"] == "ok" and not result["types"], result


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        now = {r.doc_id for r in docs.collect()}
        assert now <= ids and docs.columns[: len(columns)] == columns, name
        assert name == "mixing" or docs.columns == columns
        ids = now
    assert ids and {"copies", "taken"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(ids)


def _small_tables(spark, folder, rows):
    """documents with odd rows and columns of any type and clashing names, and the tables beside them."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("clash") for c in ("_row", "_sha", "_gone", "key", "label", "kept")})
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.col("lang")))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 2 == 0), 0) for i in range(40)]
    spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    items = [(1, PASSAGE), (2, None), (3, "")] if rows else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


PASSAGE = " ".join(f"bench{i}" for i in range(30))


def test_odd_rows_through_all_stages(spark, tmp_path):
    good = lambda i: " ".join(f"fine{(i * 7 + j * j) % 97}" for j in range(30))
    rows = [(i, good(i) if i % 2 == 0 else "junk !!! junk ???" * 5, "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, good(2), "en", "s0", 1)] * 2 + [(101, good(4).upper(), "en", None, 1)]
    rows += [(102, good(6) + " " + PASSAGE, None, "s1", None), (103, None, None, None, None), (104, "", None, None, 0)]
    rows += [(None, good(8), "en", "s2", 1), (105, " ".join(good(i) for i in range(0, 4000, 2)), "en", "s2", 1)]
    docs = _small_tables(spark, str(tmp_path / "t"), rows)
    out = corpus_pipeline.run(spark, str(tmp_path / "t"))
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) and all(r.tags == {"k": r.lang} and r["_row"] == "clash" for r in got)
    assert 102 not in ids and 105 in ids and not {i for i in range(1, 40, 2)} & set(ids)
    assert (100 in ids) + (2 in ids) == 1 and (101 in ids) + (4 in ids) == 1


def test_empty_tables_through_all_stages(spark, tmp_path):
    docs = _small_tables(spark, str(tmp_path / "t"), [])
    out = corpus_pipeline.run(spark, str(tmp_path / "t"))
    assert out.count() == 0 and out.columns[: len(docs.columns)] == docs.columns
