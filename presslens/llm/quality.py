"""Document quality by logistic regression on hashed word n-grams.

Tokens are runs of letters and digits, and single other characters; one and two tokens in a
row are features, hashed into 2**bits weights; a token followed by itself is one feature whatever
the token. A document's value of a feature is its count
over the root of the number of tokens. Training follows the regularised leader (FTRL with
L1 and L2) document by document over at most `max_rows` labelled ids, chosen by a hash of the
id, and `max_texts` distinct texts of each; it is the only step in one task, and its input is
bounded by these parameters. Scoring is a sparse dot product with the broadcast weights (4 * 2**bits bytes).

Labels other than 0 and 1, labels of no document and documents labelled both ways are left
out of training. Null and blank texts have no feature and get the score of the bias. Without
labels every score is 0.5. Rows repeat as they come; other columns are kept, but columns of docs
named held_out, score or predicted are replaced by `scored`. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from presslens.llm import textkit

BITS = 18
MAX_ROWS = 8000
MAX_TEXTS = 4
EPOCHS = 2
THRESHOLD = 0.3
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


def features(texts: list[bytes], bits: int) -> list[np.ndarray]:
    """Feature numbers of each text, repeated as they occur: unigrams, then bigrams."""
    words, at = textkit.word_hashes(
        [" ".join(_TOKEN.findall(t.decode("utf-8", "replace"))).encode() for t in texts]
    )
    shift = np.uint64(64 - bits)
    single = (words >> shift).astype(np.int32)
    double = (textkit.ngram_hashes(words, 2) >> shift).astype(np.int32)
    double[words[1:] == words[:-1]] = 0
    return [
        np.concatenate((single[s:e], double[s : max(s, e - 1)])) for s, e in zip(at[:-1], at[1:])
    ]


def _encode(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                packed = [f.tobytes() for f in features(texts, bits)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(packed, pa.binary())],
                    names=["_order", "label", "features"],
                )

    return run


def _value(n: int) -> float:
    return 1.0 / np.sqrt(max(1, (n + 1) / 2))


def _train(bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    """Follow the regularised leader over the rows of one partition, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = np.frombuffer(packed, np.int32)
                index, count = np.unique(found, return_counts=True)
                # one more entry, the bias
                index = np.append(index, 1 << bits)
                rows.append((label, index, np.append(count * _value(len(found)), 1.0)))
        z = np.zeros((1 << bits) + 1)
        n = np.zeros((1 << bits) + 1)

        def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
            live = np.abs(zi) > l1
            return np.where(live, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

        for _ in range(epochs):
            for label, index, x in rows:
                zi, ni = z[index], n[index]
                w = weights(zi, ni)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
                sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
                z[index] = zi + g - sigma * w
                n[index] = ni + g * g
        packed = weights(z, n).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["weights"])

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    bits: int = BITS,
    max_rows: int = MAX_ROWS,
    max_texts: int = MAX_TEXTS,
    epochs: int = EPOCHS,
    alpha: float = 0.1,
    beta: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.1,
) -> np.ndarray:
    """2**bits weights and the bias, learnt from the labelled documents."""
    order = F.xxhash64("doc_id")
    agreed = (
        labels.filter(F.col(label_col).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("_most"))
        .filter("label = _most")
    )
    texts = docs.select("doc_id", "text")
    known = agreed.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = known.select("doc_id", "label").orderBy(order, "doc_id").limit(max_rows)
    rows = texts.join(sample, "doc_id").select(order.alias("_order"), "label", "text")
    encoded = rows.mapInArrow(_encode(bits), "_order long, label int, features binary")
    # An id may stand for any number of rows; equal ones count once and a task passes on few others.
    nth = F.row_number().over(Window.partitionBy("_order").orderBy(F.xxhash64("features"), "features"))
    encoded = encoded.distinct().withColumn("_nth", nth).filter(F.col("_nth") <= max_texts).drop("_nth")
    one = encoded.repartition(1).sortWithinPartitions("_order", "label", "features")
    model = one.mapInArrow(_train(bits, epochs, alpha, beta, l1, l2), "weights binary")
    row = model.first()  # none without any labelled document
    return np.frombuffer(row["weights"], np.float32) if row else np.zeros((1 << bits) + 1, np.float32)


def score(weights: np.ndarray, spark, text: Column | str) -> Column:
    """Probability of label 1 of a text column, by a sparse dot product."""
    bits = (len(weights) - 1).bit_length() - 1
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf(DoubleType())
    def apply(column: pa.Array) -> pa.Array:
        w = shared.value
        out = []
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        for _, texts in textkit.slices(batch, "text"):
            for found in features(texts, bits):
                out.append(float(w[found].sum(dtype=np.float64)) * _value(len(found)))
        raw = np.array(out) + float(w[-1]) if out else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))))

    return apply(text if isinstance(text, Column) else F.col(text))


def held_out(folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text falls into the fold that is never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """All columns of docs with held_out, score and predicted."""
    weights = train(docs.filter(~held_out()), labels, **options)
    docs = docs.drop("held_out", "score", "predicted")
    out = docs.withColumn("held_out", held_out())
    out = out.withColumn("score", score(weights, docs.sparkSession, "text"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Documents that the classifier does not reject, with their own columns."""
    weights = train(docs.filter(~held_out()), labels, **options)
    return docs.filter(score(weights, docs.sparkSession, "text") >= threshold)
