"""Shared storage used to cut lineage and to hold intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def storage_root(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`; where that is unset, one below the warehouse,
    which a cluster keeps in shared storage."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is written yet."""
    return f"{storage_root(spark)}/presslens/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that lost executors do not replay the whole history."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(storage_root(df.sparkSession))
    return df.checkpoint(eager=True)


def cut_estimates(df: DataFrame) -> DataFrame:
    """cut_lineage for loops that join tables which earlier joins of the loop have made.

    A checkpoint keeps the planner's estimate of its size, and a join multiplies those of its sides: the digits
    double from step to step, until planning takes longer than any work. Here the rows are a table of unknown
    size, and adaptive execution goes by the sizes it meets.
    """
    kept, session = cut_lineage(df), df.sparkSession
    rows = session._jsparkSession.createDataFrame(kept._jdf.toJavaRDD(), kept._jdf.schema())
    return DataFrame(rows, session)
