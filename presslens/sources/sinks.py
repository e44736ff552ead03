"""Writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presslens.functions.text import file_safe


def write_text_report(df: DataFrame, path: str, separator: str = " ") -> None:
    """One text line per row."""
    line = F.concat_ws(separator, *(F.col(c).cast("string") for c in df.columns))
    df.select(line.alias("value")).write.text(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows; every part file has its own header, so none is read back as data."""
    df.write.mode("append").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_max_rows(df: DataFrame, path: str, n: int = 500_000) -> None:
    """CSV files of at most n rows each."""
    df.write.option("maxRecordsPerFile", n).option("header", True).option("escape", '"').csv(path)


def write_by_key(df: DataFrame, path: str, key: str, safe: str = "safe_name") -> None:
    """One folder per key value; characters unsafe in file names become '_'.

    Rows are rebalanced by folder first: small keys are one file each, and a frequent key is
    cut into several tasks, instead of one file per task and key.
    """
    named = df.withColumn(safe, file_safe(F.col(key)))
    named.hint("rebalance", F.col(safe)).write.partitionBy(safe).parquet(path)


def append_run_log(
    spark: SparkSession,
    path: str,
    usage: DataFrame,
    elapsed_seconds: float,
    now: dt.datetime | None = None,
) -> None:
    """One JSON line per run around a one-row usage table."""
    now = now or dt.datetime.now(dt.timezone.utc)
    stamp: dict[str, Column] = {
        "date": F.lit(now.date().isoformat()),
        "time": F.lit(now.strftime("%H:%M")),
        "elapsed_seconds": F.lit(float(elapsed_seconds)),
    }
    usage.withColumns(stamp).coalesce(1).write.mode("append").json(path)
