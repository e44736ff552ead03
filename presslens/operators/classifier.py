"""Text label classifier on vectors or hashed words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from presslens.sources.storage import write_table

HASH_FEATURES = 1 << 16


@dataclass
class TextClassifier:
    """One logistic regression per boolean label over shared features."""

    features: PipelineModel | None
    models: dict[str, object]
    vector: str | None
    threshold: float
    text: str | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds `<label>_pred` for every label; a null text counts as empty."""
        rows = _with_features(df, self.features, self.vector, self.text)
        for label, model in self.models.items():
            scored = model.transform(rows)
            positive = vector_to_array(F.col(model.getProbabilityCol()))[1] >= self.threshold
            rows = scored.withColumn(f"{label}_pred", positive).drop(
                model.getProbabilityCol(), model.getRawPredictionCol(), model.getPredictionCol()
            )
        return rows.drop("_features", "_text", "_words", "_counts")


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))


def _with_features(
    df: DataFrame, features: PipelineModel | None, vector: str | None, text: str | None
) -> DataFrame:
    if vector is not None:
        return df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    return features.transform(_with_text(df, text))


def train_text_classifier(
    df: DataFrame,
    labels: list[str],
    vector: str | None = None,
    text: str | None = None,
    threshold: float = 0.5,
    max_iter: int = 50,
    reg: float = 0.01,
) -> TextClassifier:
    """Fit one model per label; each label needs both classes.

    Features are computed once and written with the labels, so the passes of all labels read
    them from there. Rows without features (null vector or text) or without a label teach
    that label nothing.
    """
    features = None
    if vector is None:
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=HASH_FEATURES),
            IDF(inputCol="_counts", outputCol="_features"),
        ]
        features = Pipeline(stages=stages).fit(_with_text(df.filter(F.col(text).isNotNull()), text))
    rows = _with_features(df.filter(F.col(vector or text).isNotNull()), features, vector, text)
    rows = write_table(rows.select("_features", *labels), "features")
    balance = rows.agg(*(F.avg(F.col(v).cast("int")).alias(v) for v in labels)).first()
    lonely = [v for v in labels if balance[v] in (None, 0.0, 1.0)]
    if lonely:
        raise ValueError(f"only one class present for {lonely}")
    models = {}
    for label in labels:
        fit_rows = rows.select("_features", F.col(label).cast("double").alias("_y")).na.drop()
        models[label] = LogisticRegression(
            featuresCol="_features", labelCol="_y", maxIter=max_iter, regParam=reg,
            probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c",
        ).fit(fit_rows)
    return TextClassifier(features, models, vector, threshold, text)
