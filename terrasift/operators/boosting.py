"""Boosting rounds and iterations with their losses, and where to stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.functions.hashing import row_hash, unit_interval
from terrasift.operators.models import MODEL_SEED, boosted_trees, training_rows
from terrasift.operators.quality import require_columns

# Share of rows that validate, and the least gain of a round as a share of the loss.
VALIDATION_SHARE = 0.2
VALIDATION_TOL = 0.01
# End of fixed values.
VALIDATES = "_validates"


def mark_validation(df: DataFrame, key_cols, share=VALIDATION_SHARE, seed=MODEL_SEED) -> DataFrame:
    """Add ``_validates``, true for a share of the rows by the hash of their key."""
    return df.withColumn(VALIDATES, unit_interval(row_hash(key_cols, seed)) < share)


def stop_round(losses, tol=VALIDATION_TOL) -> int:
    """Rounds to keep: all before the first that gains less than ``tol`` of the loss, up to the least loss so far."""
    best, kept = losses[0], 1
    for number, loss in enumerate(losses[1:], 2):
        if best - loss < tol * max(loss, 0.01):
            return kept
        if loss < best:
            best, kept = loss, number
    return kept


def fit_until(df: DataFrame, label: str, key_cols, share=VALIDATION_SHARE, tol=VALIDATION_TOL, features="features", **params):
    """Boosted trees that stop at the round from which the validation rows gain less than ``tol``.

    Only the training rows are fitted; the validation rows are those of :func:`mark_validation`.
    """
    require_columns(df, [features, label, *key_cols])
    marked = mark_validation(df, key_cols, share)
    estimator = boosted_trees(label, features, validationIndicatorCol=VALIDATES, validationTol=tol, **params)
    with training_rows(marked, [features, label, VALIDATES]) as rows:
        return estimator.fit(rows)


def loss_table(model, train: DataFrame, validation: DataFrame, tol=VALIDATION_TOL, loss="squared") -> DataFrame:
    """round (from 1), train_loss, validation_loss and kept, for every round of a boosted model.

    Each table is read once for all rounds. ``kept`` marks the rounds that :func:`stop_round` keeps.
    """
    on_train, on_validation = (list(model.evaluateEachIteration(part, loss)) for part in (train, validation))
    kept = stop_round(on_validation, tol)
    rows = [(k, float(a), float(b), k <= kept) for k, (a, b) in enumerate(zip(on_train, on_validation), 1)]
    return train.sparkSession.createDataFrame(rows, "round int, train_loss double, validation_loss double, kept boolean")


def objective_history(model) -> DataFrame:
    """iteration (from 0) and objective of a model fitted by iterations; models solved at once have one row or none."""
    rows = [(k, float(value)) for k, value in enumerate(model.summary.objectiveHistory)]
    return SparkSession.active().createDataFrame(rows, "iteration int, objective double")


def losses_by_class(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """label, rows and mean negative log-likelihood of the true class, from an array of class probabilities."""
    p = F.greatest(F.element_at(F.col(probability), F.col(label).cast("int") + 1), F.lit(1e-15))
    return scored.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"), F.avg(-F.log(p)).alias("loss"))
