"""Readers with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslens.operators.ranking import skip_data_rows

# File patterns of the moderation items.
ITEM_PATTERNS = {"all": "R[SC]_*.jsonl", "posts": "RS_*.jsonl", "comments": "RC_*.jsonl"}


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: str,
    encoding: str = "UTF-8",
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes.

    Quoted line breaks need multi_line, with which a file is read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_tsv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    return read_csv_typed(spark, path, schema, sep="\t", multi_line=multi_line)


def read_folder_union(
    spark: SparkSession, folder: str, schema: str, tag: str = "source_file", glob: str = "*.csv"
) -> DataFrame:
    """All CSV files of a folder in one scan, tagged with their file name.

    A file whose header differs from the schema is an error; see read_folders_by_name.
    """
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    reader = reader.option("enforceSchema", False).option("recursiveFileLookup", True)
    out = reader.option("pathGlobFilter", glob).csv(folder)
    return out.withColumn(tag, F.col("_metadata.file_name"))


def read_folders_by_name(
    spark: SparkSession, folders: dict[str, str], tag: str = "source", multi_line: bool = False
) -> DataFrame:
    """Union of CSV folders with different headers, by column name ({folder: schema})."""
    parts = [
        read_csv_typed(spark, path, schema, multi_line=multi_line).withColumn(
            tag, F.lit(path.rstrip("/").split("/")[-1])
        )
        for path, schema in folders.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_csv_skipping(
    spark: SparkSession, path: str, schema: str, n: int, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """Keep the header, drop the first n data rows of a file.

    The file is read in splits; quoted line breaks need multi_line, with which one task reads it.
    """
    df = read_csv_typed(spark, path, schema, encoding, multi_line=multi_line)
    # Splits follow each other by their first byte, and within a split ids follow the rows.
    placed = df.withColumns(
        {"_split": F.col("_metadata.file_block_start"), "_position": F.monotonically_increasing_id()}
    )
    return skip_data_rows(placed, ["_split", "_position"], n).drop("_split", "_position")


def read_jsonl_glob(spark: SparkSession, folder: str, schema: str, kind: str = "all") -> DataFrame:
    """JSON-lines files chosen by kind: all, posts or comments."""
    if kind not in ITEM_PATTERNS:
        raise NotImplementedError(f"Invalid pattern: {kind}")
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/{ITEM_PATTERNS[kind]}")


def read_json_array(
    spark: SparkSession, path: str, schema: str, one_list_per_line: bool = False
) -> DataFrame:
    """Files holding one list of objects, or (splittable) one list per line."""
    return spark.read.schema(schema).option("multiLine", not one_list_per_line).json(path)
