"""A versioned parquet table of (id, document, embedding): append to upsert, reduce to scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslens.operators.dedup import keep_first
from presslens.sources.storage import write_table


def upsert(df: DataFrame, path: str, version: int) -> None:
    """Write a new version of some ids; older versions stay until compaction."""
    df.withColumn("version", F.lit(version).cast("bigint")).write.mode("append").parquet(path)


def scan(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """Newest version of every id; of equal versions the first by the other columns.

    Ids and versions alone are grouped to find the ids with several rows. That list is written,
    so its size is known: a short one is broadcast, and then rows with one version do not
    move and of the others only the newest do.
    """
    rows = spark.read.parquet(path)
    versions = rows.groupBy(F.col(id_col).alias("_known_id")).agg(
        F.max("version").alias("_newest"), F.count("*").alias("_n")
    )
    several = write_table(versions.filter("_n > 1").drop("_n").withColumn("_several", F.lit(True)), "several")
    marked = rows.join(several, F.col(id_col).eqNullSafe(F.col("_known_id")), "left")
    own = rows.columns
    alone = marked.filter("_several is null").select(*own)
    newest = marked.filter("_several and version <=> _newest").select(*own)
    rest = sorted(c for c in own if c not in (id_col, "version"))
    return alone.unionByName(keep_first(newest, [id_col], rest))


def compact(spark: SparkSession, path: str, target: str, id_col: str = "id") -> None:
    """Save the current state as a new table."""
    scan(spark, path, id_col).write.parquet(target)
