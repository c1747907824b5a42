"""Regressors, tuning, scoring, comparison and persistence on MLlib."""

from __future__ import annotations

import logging
import math
from contextlib import contextmanager, nullcontext
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.functions.hashing import row_hash, unit_interval
from terrasift.functions.numeric import quoted
from terrasift.functions.vectors import vector_to_array
from terrasift.operators import counted, metrics, splits
from terrasift.operators.features import feature_stages
from terrasift.operators.quality import cast_columns, drop_missing, require_columns, require_rows
from terrasift.registry import DatasetSpec
from terrasift.session import stage_table

log = logging.getLogger(__name__)

# Hyper-parameters and grids.
MODEL_SEED = 42
LINEAR_GRID = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}
TREE_GRID = {"maxDepth": [5, 10], "minInstancesPerNode": [1, 4]}
FOREST_GRID = {"numTrees": [20, 50], "maxDepth": [5, 10]}
BOOST_PARAMS = {"maxIter": 50, "maxDepth": 10}
APP_TREES = 100
CV_PARALLELISM = 4
# End of fixed values.

FOLD = "_fold"
TRAINING_ROWS = 20_000


def linear(label, features="features", **params):
    return LinearRegression(featuresCol=features, labelCol=label, **params)


def decision_tree(label, features="features", **params):
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=MODEL_SEED, **params)


def random_forest(label, features="features", **params):
    return RandomForestRegressor(featuresCol=features, labelCol=label, seed=MODEL_SEED, **params)


def boosted_trees(label, features="features", **params):
    return GBTRegressor(featuresCol=features, labelCol=label, seed=MODEL_SEED, **{**BOOST_PARAMS, **params})


def grid(estimator, values: dict) -> list:
    """Parameter maps bound to this estimator's own params."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder.addGrid(estimator.getParam(name), options)
    return builder.build() if values else []


def candidates(label, features="features", boost_params=None) -> dict:
    """The four compared regressors with their grids; boosting is not tuned."""
    return {
        "Linear Regression": (linear(label, features), LINEAR_GRID),
        "Decision Tree Regression": (decision_tree(label, features), TREE_GRID),
        "Random Forest Regression": (random_forest(label, features), FOREST_GRID),
        "GBT Regression": (boosted_trees(label, features, **(boost_params or {})), {}),
    }


@contextmanager
def training_rows(df: DataFrame, columns, partitions=None):
    """Only the columns a fit reads, cached while it iterates.

    Rows are dealt by their hash into ``partitions`` (by default one for every
    ``TRAINING_ROWS`` rows, up to the larger of 200 and the shuffle partitions):
    forests seed their draws per partition, so a fit must not depend on the
    number of cores or on how files were split.
    """
    chosen = [quoted(c) for c in columns]
    most = max(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    partitions = partitions or min(most, max(1, -(-df.count() // TRAINING_ROWS)))
    rows = df.select(*chosen).repartition(partitions, *chosen).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def fit(estimator, df: DataFrame):
    """Fit on cached rows holding just the features and the label."""
    with training_rows(df, [estimator.getFeaturesCol(), estimator.getLabelCol()]) as rows:
        return estimator.fit(rows)


def with_folds(df: DataFrame, key_cols, folds, seed=MODEL_SEED) -> DataFrame:
    """Add the fold number of each row, from a hash of its key.

    Folds drawn at random per partition would change when a lost executor makes
    Spark recompute a shuffled input in another order.
    """
    return df.withColumn(FOLD, F.floor(unit_interval(row_hash(key_cols, seed)) * folds).cast("int"))


def _validate(rows, estimator, values, label, folds, seed=MODEL_SEED, parallelism=CV_PARALLELISM, weight=None):
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid(estimator, values), numFolds=folds, seed=seed,
        foldCol=FOLD, parallelism=parallelism,
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse", **({"weightCol": weight} if weight else {})))
    return validator.fit(rows)


def cross_validate(df, estimator, values, label, key_cols, folds=3, seed=MODEL_SEED, parallelism=CV_PARALLELISM):
    """Fit the grid by RMSE; returns a ``CrossValidatorModel``.

    Single trees of large tables are fitted on counted bins, the best one then
    reads the features as they are.
    """
    folded = with_folds(df, key_cols, folds, seed)
    if values and isinstance(estimator, DecisionTreeRegressor) and counted.suits(estimator):
        bins = counted.settle(df, estimator.getFeaturesCol(), estimator.getMaxBins())
        if bins:
            found = counted.tune(folded, bins, estimator, values, label, key_cols, folds, FOLD)
            maps = grid(estimator, values)
            best = estimator.copy(next(m for m in maps if {p.name: v for p, v in m.items()} == found.chosen))
            validated = CrossValidatorModel(counted.tree_on_values(found, best), found.errors)
            return validated._set(estimatorParamMaps=maps, numFolds=folds, seed=seed, foldCol=FOLD)
    with training_rows(folded, [estimator.getFeaturesCol(), label, FOLD]) as rows:
        return _validate(rows, estimator, values, label, folds, seed, parallelism)


def fit_best(df: DataFrame, estimator, values, label, key_cols, folds=3, seed=MODEL_SEED):
    """The estimator, or the best cell of its grid by RMSE, fitted on all rows.

    Boosted trees and forests of large tables are fitted on counted bins, others on the rows.
    """
    features = estimator.getFeaturesCol()
    bins = counted.settle(df, features, estimator.getMaxBins(), counted.least_rows(estimator)) if _counts(estimator) else None
    if bins:
        return counted.tune(with_folds(df, key_cols, folds, seed), bins, estimator, values or {}, label, [*key_cols, features], folds, FOLD)
    return cross_validate(df, estimator, values, label, key_cols, folds, seed).bestModel if values else fit(estimator, df)


def _counts(estimator) -> bool:
    """A single tree reads the rows a few times only, so it is fitted on them."""
    return not isinstance(estimator, DecisionTreeRegressor) and counted.suits(estimator)


def cv_report(spark: SparkSession, cv_model) -> DataFrame:
    """Mean RMSE per grid cell; ``best`` marks the chosen one."""
    scores = list(cv_model.avgMetrics)
    best = scores.index(min(scores))
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             float(scores[i]), i == best)
            for i, m in enumerate(cv_model.getEstimatorParamMaps())]
    return spark.createDataFrame(rows, "cell int, params string, rmse double, best boolean")


def parameter_report(spark: SparkSession, model, name=None) -> DataFrame:
    """Every parameter of a fitted model as text."""
    name = name or type(model).__name__
    rows = [(name, p.name, str(v)) for p, v in sorted(model.extractParamMap().items(), key=lambda kv: kv[0].name)]
    return spark.createDataFrame(rows, "model string, param string, value string")


def fit_features(train: DataFrame, columns, pca_k=None, staged=False, **options) -> PipelineModel:
    """Feature pipeline fitted on training rows only; ``staged`` rows are read where they lie."""
    if staged:
        return Pipeline(stages=feature_stages(columns, pca_k, **options)).fit(train.select(*[quoted(c) for c in columns]))
    with training_rows(train, columns) as rows:
        return Pipeline(stages=feature_stages(columns, pca_k, **options)).fit(rows)


def narrow_rows(df: DataFrame, label: str, extra=()) -> tuple:
    """The rows staged with the elements of ``features`` as plain columns, from which ``features`` is made again, and their names."""
    width = df.select(F.size(vector_to_array("features"))).first()[0]
    names = [f"_x{k}" for k in range(width)]
    taken = df.select(vector_to_array("features").alias("_elements"), quoted(label), *extra)
    kept = [c for c in taken.columns if c != "_elements"]
    staged = stage_table(taken.select(*[F.col("_elements")[k].alias(n) for k, n in enumerate(names)], *[quoted(c) for c in kept]), "narrow")
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(staged), names


def leaderboard(train: DataFrame, test: DataFrame, models: dict, label: str, key_cols, folds=3,
                parallelism=CV_PARALLELISM) -> DataFrame:
    """RMSE, within-threshold accuracy and chosen parameters of each model, measured on ``test``.

    A model that fails gets an infinite RMSE, accuracy 0 and the reason; the
    others are still compared. Both tables need a ``features`` vector. The
    models do not depend on each other and are fitted side by side.
    """
    from terrasift.operators import fold_sums
    spark = train.sparkSession
    whole, elements, sums = with_folds(train, key_cols, folds), "features", None
    # The rows of a large table are split, scaled and hashed once.
    if (total := train.count()) >= counted.LEAST_ROWS:
        key = counted.row_key([*dict.fromkeys([*key_cols, "features", label])]).alias(counted.ROW_KEY)
        (whole, elements), (test, _) = narrow_rows(whole, label, [F.col(FOLD), key]), narrow_rows(test, label)
        if any(fold_sums.suits(e, len(elements)) for e, _ in models.values()):
            sums = fold_sums.moment_rows(whole, elements, label, total)
    # Trees of any kind read the rows of a large table as counted bins, by their own number of bins.
    wanted = [(e.getMaxBins(), counted.least_rows(e)) for e, _ in models.values() if counted.suits(e)]
    settled = {bins: counted.settle(whole, elements, bins, min(n for b, n in wanted if b == bins)) for bins in {b for b, _ in wanted}}

    def bins_of(estimator):
        found = settled[estimator.getMaxBins()] if counted.suits(estimator) else None
        return found if found and found.rows >= counted.least_rows(estimator) else None
    held = nullcontext(test) if elements != "features" else training_rows(test, ["features", label])
    with training_rows(whole, ["features", label, FOLD]) as train, held as test:
        def compare(entry):
            name, (estimator, values) = entry
            try:
                bins = bins_of(estimator)
                if sums is not None and fold_sums.suits(estimator, len(elements)):
                    weighted = estimator.copy({estimator.weightCol: counted.ROWS})
                    fitted = (_validate(sums, weighted, values, label, folds, weight=counted.ROWS).bestModel if values
                              else weighted.fit(sums))
                elif bins:
                    fitted = counted.tune(whole, bins, estimator, values, label, [*key_cols, "features"], folds, FOLD)
                else:
                    fitted = (_validate(train, estimator, values, label, folds).bestModel if values
                              else estimator.fit(train))
                chosen = ", ".join(f"{p}={fitted.chosen[p] if bins else fitted.getOrDefault(p)}" for p in sorted(values))
                row = metrics.regression_report(fitted.transform(test), label).first()
                return name, row["rmse"], row["accuracy"], chosen, "ok"
            except (PySparkException, Py4JJavaError, ValueError) as err:
                log.exception("model %s failed", name)
                return name, math.inf, 0.0, "", f"failed: {type(err).__name__}"

        with ThreadPool(min(parallelism, max(1, len(models)))) as pool:
            rows = pool.map(inheritable_thread_target(spark)(compare), list(models.items()))
    return spark.createDataFrame(rows, "model string, rmse double, accuracy double, params string, status string")


def train_and_score_all(df: DataFrame, spec: DatasetSpec, key_cols=None, trees=APP_TREES, **params) -> tuple:
    """Random forest on raw features: predictions for every complete row, hold-out RMSE.

    Without ``key_cols`` a row is its own key. Returns ``(predictions, rmse)``, both DataFrames.
    """
    require_columns(df, spec.required)
    ready = drop_missing(cast_columns(df, spec.required), spec.required)
    require_rows(ready, 2, spec.name)
    # The rows of a large table are parsed and hashed once: what follows reads them many times.
    marked = splits.holdout_split(ready, key_cols or ready.columns, staged=ready.count() >= counted.LEAST_ROWS)
    stages = feature_stages(spec.features, scale=False, normalize=False)
    forest, chosen = random_forest(spec.label, numTrees=trees, **params), marked.filter(F.col("split") == "train")
    bins = counted.settle(chosen, spec.features, forest.getMaxBins(), counted.least_rows(forest)) if counted.suits(forest) else None
    if bins:
        model = counted.tune(chosen, bins, forest, {}, spec.label, ready.columns, 0, FOLD)
    else:
        with training_rows(chosen, spec.required) as train:
            model = Pipeline(stages=[*stages, forest]).fit(train)
    scored = model.transform(marked)
    held_out = metrics.rmse(scored.filter(F.col("split") == "test"), spec.label)
    return scored.select(*[quoted(c) for c in df.columns], "split", "prediction"), held_out


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind=PipelineModel):
    """Load a saved model; a missing path is named in the error."""
    try:
        return kind.load(path)
    except Exception as err:  # MLlib raises Java, Py4J or Spark errors by version
        text = str(err)
        if isinstance(err, AnalysisException) or "does not exist" in text or "not exist" in text:
            raise FileNotFoundError(f"no model at {path}") from err
        raise
