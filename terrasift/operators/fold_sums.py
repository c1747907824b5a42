"""Cross-validation of linear grids from one pass over the rows.

Each fold is summed up by its count, means and co-moments. What a model trained
on the other folds needs is the merge of their sums, and its error on the fold
left out follows from that fold's own sums, so every fold and every cell of the
grid comes from one aggregate of ``folds`` rows, however large the table is.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from terrasift.functions.numeric import quoted
from terrasift.operators.counted import ROWS
from terrasift.operators.models import FOLD, LINEAR_GRID, MODEL_SEED, with_folds
from terrasift.operators.quality import require_columns

STEPS, TOLERANCE = 10_000, 1e-12  # of the coordinate descent
MOST_COLUMNS = 20  # whose co-moments are aggregated at once


def fold_moments(df: DataFrame, columns, label: str, fold_col: str = FOLD) -> dict:
    """Per fold: rows, means and sums of centred products of the columns and, last, the label; incomplete rows are left out."""
    names = [*columns, label]
    values = df.select(quoted(fold_col).alias("fold"), *[quoted(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).dropna()
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    sums = values.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs])
    out = {}
    for row in sums.collect():  # one row for each fold
        products = np.zeros((len(names), len(names)))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"c{i}_{j}"] * row["n"]
        out[row["fold"]] = (row["n"], np.array([row[f"m{i}"] for i in range(len(names))]), products)
    return out


def merged(parts) -> tuple:
    """Sums of several folds as one."""
    n, means, products = 0, 0.0, 0.0
    for count, mean, product in parts:
        total, apart = n + count, mean - means
        products = products + product + np.outer(apart, apart) * n * count / total
        means = means + apart * count / total
        n = total
    return n, means, products


def solve(moments: tuple, reg: float = 0.0, mix: float = 0.0) -> tuple:
    """(coefficients, intercept) that minimise the squared error with an elastic net on standardised columns."""
    n, means, products = moments
    spread = np.sqrt(np.diag(products) / n)
    scale = np.where(spread > 0, spread, 1.0)
    if spread[-1] == 0:
        return np.zeros(len(means) - 1), means[-1]
    relation = products / n / np.outer(scale, scale)
    system, target, strength = relation[:-1, :-1], relation[:-1, -1], reg / spread[-1]
    if mix == 0.0:
        full = system + strength * np.eye(len(target))
        beta = np.linalg.lstsq(full, target, rcond=None)[0]
    else:
        beta = np.zeros(len(target))
        for _ in range(STEPS):
            before = beta.copy()
            for j in np.flatnonzero(spread[:-1] > 0):
                pull = target[j] - system[j] @ beta + system[j, j] * beta[j]
                beta[j] = np.sign(pull) * max(abs(pull) - strength * mix, 0.0) / (system[j, j] + strength * (1 - mix))
            if np.abs(beta - before).max() < TOLERANCE:
                break
    beta = np.where(spread[:-1] > 0, beta, 0.0) * spread[-1] / scale[:-1]
    return beta, means[-1] - beta @ means[:-1]


def squared_error(moments: tuple, beta, intercept) -> float:
    """Mean squared error of a linear model on the rows that the sums stand for."""
    n, means, products = moments
    weights = np.append(-np.asarray(beta), 1.0)
    return float(max(weights @ products @ weights / n, 0.0) + (weights @ means - intercept) ** 2)


def suits(estimator, width: int) -> bool:
    """Whether the fit reads nothing of the rows but what :func:`fold_moments` holds: weighted least squares."""
    return (isinstance(estimator, LinearRegression) and not estimator.isSet("weightCol") and estimator.getLoss() == "squaredError"
            and estimator.getSolver() in ("auto", "normal") and width <= MOST_COLUMNS)


def moment_rows(df: DataFrame, columns, label: str, total: int, fold_col: str = FOLD) -> DataFrame | None:
    """A few weighted rows per fold with the count, means and co-moments of all its rows; None if some rows are incomplete.

    A linear model fitted on them, and its squared error on them, are those of the rows.
    """
    found, rows = fold_moments(df, columns, label, fold_col), []
    if sum(n for n, *_ in found.values()) != total:
        return None
    for fold, (n, means, products) in sorted(found.items()):
        spread, k = np.sqrt(np.maximum(np.diag(products) / n, 0.0)), len(means)
        scale = np.where(spread > 0, spread, 1.0)
        values, axes = np.linalg.eigh(products / n / np.outer(scale, scale))
        steps = (axes * np.sqrt(np.maximum(values, 0.0) * k)).T * spread
        rows += [(int(fold), Vectors.dense(at[:-1]), float(at[-1]), n / (2.0 * k)) for step in steps for at in (means + step, means - step)]
    names = [StructField(fold_col, IntegerType()), StructField("features", VectorUDT()), StructField(label, DoubleType()), StructField(ROWS, DoubleType())]
    return df.sparkSession.createDataFrame(rows, StructType(names)).coalesce(1).cache()


def linear_grid(df: DataFrame, columns, label: str, key_cols, grid=None, folds: int = 3, seed=MODEL_SEED) -> DataFrame:
    """cell, params, rmse (mean over the folds) and best, for every cell of ``regParam`` and ``elasticNetParam``.

    The folds, the objective and the order of cells are those of ``cross_validate`` with a linear model.
    """
    require_columns(df, [*columns, label, *key_cols])
    grid = grid or LINEAR_GRID
    found = fold_moments(with_folds(df, key_cols, folds, seed), columns, label)
    if len(found) < 2:
        raise ValueError(f"{len(found)} of {folds} folds have rows; two are needed")
    errors = []
    for reg in grid.get("regParam", [0.0]):
        for mix in grid.get("elasticNetParam", [0.0]):
            losses = [np.sqrt(squared_error(held, *solve(merged(m for g, m in sorted(found.items()) if g != f), reg, mix)))
                      for f, held in sorted(found.items())]
            errors.append((f"elasticNetParam={mix}, regParam={reg}", float(np.mean(losses))))
    best = min(range(len(errors)), key=lambda k: errors[k][1])
    rows = [(k, name, error, k == best) for k, (name, error) in enumerate(errors)]
    return df.sparkSession.createDataFrame(rows, "cell int, params string, rmse double, best boolean")
