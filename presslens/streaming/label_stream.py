"""Label newly arrived headline files once each."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession

from presslens.operators.labelling import score_in_batches


def label_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema,
    text: str,
    key: list[str],
    event_time: str,
    delay: str = "7 days",
    scorer: Callable[[pd.Series], pd.Series] | None = None,
    out: str = "label",
):
    """Start a run over the files not seen yet; returns the streaming query.

    Repeats of a key inside the delay are suppressed, older keys leave the state.
    """
    arrived = spark.readStream.schema(schema).parquet(source)
    unique = arrived.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)
    labelled = score_in_batches(unique, text, scorer, out)
    return (
        labelled.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
