"""Classifiers on feature arrays, batch inference and top classes."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from terrasift.functions import vectors
from terrasift.functions.labels import class_name
from terrasift.functions.numeric import quoted
from terrasift.operators.models import MODEL_SEED, fit
from terrasift.registry import IMAGE_CLASSES

# Batch size of inference, epochs of training.
BATCH_SIZE = 32
EPOCHS = 25
# End of fixed values.


def with_vector(df: DataFrame, features: str, output="features") -> DataFrame:
    return df.withColumn(output, array_to_vector(quoted(features)))


def fit_classifier(df: DataFrame, features: str, label: str, kind="logistic", layers=None, max_iter=EPOCHS):
    """Distributed classifier over a feature-array column."""
    if kind == "logistic":
        estimator = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter)
    elif kind == "perceptron":
        estimator = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers,
                                                   maxIter=max_iter, seed=MODEL_SEED)
    else:
        raise ValueError(f"kind must be 'logistic' or 'perceptron', not {kind!r}")
    return PipelineModel(stages=[fit(estimator, with_vector(df, features))])


def classify(df: DataFrame, model, features: str, keep=()) -> DataFrame:
    """``prediction``, ``probabilities`` (array) and ``confidence`` per row."""
    scored = model.transform(with_vector(df, features))
    probabilities = vector_to_array(F.col("probability"))
    return scored.select(*[quoted(c) for c in keep], F.col("prediction").cast("int").alias("prediction"),
                         probabilities.alias("probabilities"),
                         vectors.confidence(probabilities).alias("confidence"))


def batch_scores(df: DataFrame, features: str, width: int, make_predictor, batch_size=BATCH_SIZE) -> DataFrame:
    """Add ``scores`` from a user's model, ``status`` and ``error``.

    ``make_predictor()`` runs once per Python worker and returns a function
    from a ``(rows, width)`` array to a ``(rows, classes)`` array. A row whose
    features are null, of another width or hold a null, and a row on which the
    model fails, gets an error status; the others are not affected.
    """
    given = quoted(features)
    usable = F.coalesce((F.size(given) == width) & ~F.exists(given, lambda x: x.isNull()), F.lit(False))
    blank = F.array_repeat(F.lit(0.0), width)
    run = predict_batch_udf(lambda: _tolerant(make_predictor()), return_type=ArrayType(DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=[[width]])
    raw = run(F.when(usable, given.cast("array<double>")).otherwise(blank))
    scored = df.select("*", usable.alias("_usable"), raw.alias("_raw"))
    failed = F.exists("_raw", lambda x: x.isNull() | F.isnan(x))
    status = F.when(F.col("_usable") & ~failed, "ok").otherwise("error")
    return scored.select(
        *[quoted(c) for c in df.columns],
        F.when(status == "ok", F.col("_raw")).alias("scores"), status.alias("status"),
        F.when(~F.col("_usable"), "unusable features").when(failed, "model failed").alias("error"))


def _tolerant(predict):
    """Run a whole batch; when that fails, row by row, failing rows as NaN."""
    def run(batch: np.ndarray) -> np.ndarray:
        try:
            return np.asarray(predict(batch), dtype=float)
        except Exception:
            rows = []
            for row in batch:
                try:
                    rows.append(np.asarray(predict(row[None, :]), dtype=float)[0])
                except Exception:
                    rows.append(None)
            width = max((len(r) for r in rows if r is not None), default=1)
            return np.stack([np.full(width, np.nan) if r is None else r for r in rows])
    return run


def top_class(df: DataFrame, scores: str, names=IMAGE_CLASSES, keep=()) -> DataFrame:
    """Softmax of a score array, its top class and confidence; null scores stay null."""
    # One struct, bound once: probabilities, their maximum and its place.
    made = vectors.bound(vectors.softmax(quoted(scores)), lambda p: vectors.bound(F.array_max(p), lambda top: F.struct(
        p.alias("probabilities"), (F.array_position(p, top) - 1).cast("int").alias("class_id"), top.alias("confidence"))))
    rows = df.select(*[quoted(c) for c in keep], made.alias("_top"))
    return rows.select(*[quoted(c) for c in keep], "_top.probabilities", "_top.class_id",
                       class_name(F.col("_top.class_id"), names).alias("predicted"), "_top.confidence")
