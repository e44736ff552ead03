"""S: sources and sinks. Tables are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators.aggregates import count_by, usage_totals
from presslens.operators.ranking import skip_data_rows
from presslens.plans.registry import query
from presslens.plans.views import headlines, table
from presslens.sources import readers, sinks, vector_table
from presslens.sources.storage import scratch_path


@query("s01_read_csv_typed", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def s01(spark, d):
    path = scratch_path(spark, "csv")
    columns = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    part = table(spark, d, "part").select(*columns)
    part.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    return readers.read_csv_typed(spark, path, schema, encoding="ISO-8859-1")


@query(
    "s02_read_folder_union",
    """SELECT o_orderstatus AS source, count(*) AS n, count(o_orderpriority) AS n_priority
       FROM (SELECT o_orderstatus,
                    CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
             FROM orders) GROUP BY 1""",
)
def s02(spark, d):
    root = scratch_path(spark, "folders")
    orders = table(spark, d, "orders")
    schemas = {}
    for status in ("F", "O", "P"):
        columns = ["o_orderkey"] if status == "F" else ["o_orderkey", "o_orderpriority"]
        part = orders.filter(F.col("o_orderstatus") == status).select(*columns)
        part.write.option("header", True).csv(f"{root}/{status}")
        kinds = {"o_orderkey": "bigint", "o_orderpriority": "string"}
        schemas[f"{root}/{status}"] = ", ".join(f"{c} {kinds[c]}" for c in columns)
    merged = readers.read_folders_by_name(spark, schemas)
    return merged.groupBy("source").agg(
        F.count("*").alias("n"), F.count("o_orderpriority").alias("n_priority")
    )


@query(
    "s02_read_folder_tagged",
    """SELECT count(*) AS n, true AS tagged, CAST(sum(s_suppkey) AS BIGINT) AS key_sum
       FROM supplier""",
)
def s02_tagged(spark, d):
    path = scratch_path(spark, "tagged")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_name")
    supplier.write.option("header", True).csv(path)
    tagged = readers.read_folder_union(spark, path, "s_suppkey bigint, s_name string")
    return tagged.agg(
        F.count("*").alias("n"),
        F.every(F.col("source_file").endswith(".csv")).alias("tagged"),
        F.sum("s_suppkey").alias("key_sum"),
    )


@query(
    "s03_skip_data_rows",
    """SELECT o_orderkey, o_totalprice FROM (
         SELECT o_orderkey, o_totalprice,
                row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       WHERE rn > 25""",
)
def s03(spark, d):
    orders = table(spark, d, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    kept = skip_data_rows(orders, ["o_orderdate", "o_orderkey"], 25)
    return kept.select("o_orderkey", "o_totalprice")


@query("s04_read_tsv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s04(spark, d):
    path = scratch_path(spark, "tsv")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    rows = table(spark, d, "customer").select(*columns)
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_tsv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query(
    "s05_read_jsonl_glob",
    "SELECT event_id AS id, event_type AS subreddit, value FROM events WHERE event_type <> 'error'",
)
def s05(spark, d):
    root = scratch_path(spark, "jsonl")
    events = table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("subreddit"), "value"
    )
    comments = F.col("subreddit").isin("click", "view")
    posts = F.col("subreddit").isin("signup", "purchase")
    events.filter(comments).write.json(f"{root}/RC_items.jsonl")
    events.filter(posts).write.json(f"{root}/RS_items.jsonl")
    events.filter(~comments & ~posts).write.json(f"{root}/other.jsonl")
    return readers.read_jsonl_glob(spark, root, "id bigint, subreddit string, value double")


@query("s06_read_json_array", "SELECT conv_id, turn, role, 'label' AS category FROM conversations")
def s06(spark, d):
    source, target = scratch_path(spark, "lists"), scratch_path(spark, "enriched")
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role")
    turns.select(F.to_json(F.array(F.struct("*"))).alias("value")).write.text(source)
    schema = "conv_id bigint, turn bigint, role string"
    items = readers.read_json_array(spark, source, schema, one_list_per_line=True)
    sinks.write_json(items.withColumn("category", F.lit("label")), target)
    return spark.read.schema(schema + ", category string").json(target)


@query(
    "s07_write_text_report",
    "SELECT p_brand || ' ' || CAST(count(*) AS VARCHAR) AS line FROM part GROUP BY p_brand",
)
def s07(spark, d):
    path = scratch_path(spark, "report")
    sinks.write_text_report(count_by(table(spark, d, "part"), ["p_brand"]), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("s08_append_csv", "SELECT s_suppkey, s_name FROM supplier")
def s08(spark, d):
    path = scratch_path(spark, "append")
    supplier = table(spark, d, "supplier")
    sinks.append_csv(supplier.select("s_suppkey", "s_name").limit(0), path)
    rich = F.col("s_acctbal") >= 5000
    for chunk in (rich, ~rich):
        sinks.append_csv(supplier.filter(chunk).select("s_suppkey", "s_name"), path)
    return readers.read_csv_typed(spark, path, "s_suppkey bigint, s_name string")


@query("s09_write_max_rows", "SELECT count(*) AS n_rows, true AS within_limit FROM orders")
def s09(spark, d):
    path = scratch_path(spark, "limited")
    sinks.write_max_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey"), path, 5000)
    rows = readers.read_folder_union(spark, path, "o_orderkey bigint, o_custkey bigint")
    files = rows.groupBy("source_file").agg(F.count("*").alias("n"))
    return files.agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= 5000).alias("within_limit")
    )


@query(
    "s10_write_by_key",
    r"""SELECT regexp_replace(publication, '[^A-Za-z0-9_\-]', '_', 'g') AS safe_name,
               count(*) AS n FROM headlines_v GROUP BY 1""",
    ("headlines_v",),
)
def s10(spark, d):
    path = scratch_path(spark, "by-key")
    sinks.write_by_key(headlines(spark, d).select("page_id", "publication"), path, "publication")
    rows = spark.read.schema("page_id bigint, publication string, safe_name string").parquet(path)
    return rows.groupBy("safe_name").agg(F.count("*").alias("n"))


@query(
    "s11_vector_table_upsert",
    """SELECT vec_id AS id, CAST(CASE WHEN label < 5 THEN 2 ELSE 1 END AS BIGINT) AS version,
              CAST(len(embedding) AS INTEGER) AS dims
       FROM embeddings""",
)
def s11(spark, d):
    path = scratch_path(spark, "vectors")
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("document"), "embedding"
    )
    vector_table.upsert(rows, path, 1)
    vector_table.upsert(rows.filter("document < 5"), path, 2)
    newest = vector_table.scan(spark, path)
    return newest.select("id", "version", F.size("embedding").alias("dims"))


@query(
    "s12_append_run_log",
    r"""SELECT count(*) AS records_processed,
              CAST(sum(len(regexp_extract_all(text, '\S+'))) AS BIGINT) AS tokens_prompted
       FROM conversations""",
)
def s12(spark, d):
    path = scratch_path(spark, "runs")
    turns = table(spark, d, "conversations").withColumn("reply", F.lit(""))
    sinks.append_run_log(spark, path, usage_totals(turns, "text", "reply", 0.005, 0.015), 1.5)
    schema = "date string, time string, records_processed bigint, tokens_prompted bigint"
    return spark.read.schema(schema).json(path).select("records_processed", "tokens_prompted")
