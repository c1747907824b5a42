"""Model comparison that can be resumed.

Every unit of work, (model, cell, fold), leaves a row in a table in a shared
folder as soon as it is done. A run first reads what is there and fits only what
is pending, so a lost driver costs the units that were running and no more.
"""

from __future__ import annotations

import hashlib
import logging
import math
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.operators import metrics
from terrasift.operators.models import CV_PARALLELISM, FOLD, MODEL_SEED, grid, training_rows, with_folds

log = logging.getLogger(__name__)

SCHEMA = "model string, cell int, params string, fold int, rmse double, accuracy double, status string"
FINAL = -1  # the fold of the fit on all training rows, measured on the test rows


def finished(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the units that are done."""
    spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{folder}/start")
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)


def record(spark: SparkSession, folder: str, row: tuple) -> None:
    """Write the row of one unit. Its place follows from its key, so writing it again replaces it."""
    key = hashlib.md5(repr(row[:4]).encode()).hexdigest()
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{key}")


def run_pending(spark: SparkSession, folder: str, units: dict, parallelism=CV_PARALLELISM) -> list:
    """Run the units whose key (model, cell, params, fold) has no row yet; returns the keys that ran.

    A unit returns (rmse, accuracy). One that fails leaves a row with its error and an infinite RMSE, and is pending
    again in the next run.
    """
    done = {(r["model"], r["cell"], r["params"], r["fold"]) for r in finished(spark, folder).filter("status = 'ok'").collect()}
    pending = [key for key in units if key not in done]

    def run(key):
        try:
            rmse, accuracy = units[key]()
            row = (*key, float(rmse), float(accuracy), "ok")
        except (PySparkException, Py4JJavaError, ValueError) as err:
            log.exception("%s failed", key)
            row = (*key, math.inf, 0.0, f"failed: {type(err).__name__}")
        record(spark, folder, row)

    if pending:
        with ThreadPool(min(parallelism, len(pending))) as pool:
            pool.map(inheritable_thread_target(spark)(run), pending)
    return pending


def _cells(estimator, values: dict) -> list:
    """(cell, params as text, parameter map) of a grid; without one, a single cell."""
    maps = grid(estimator, values) or [{}]
    return [(k, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), m) for k, m in enumerate(maps)]


def compare(train: DataFrame, test: DataFrame, models: dict, label: str, key_cols, folder: str, folds: int = 3,
            seed=MODEL_SEED, parallelism=CV_PARALLELISM) -> tuple[DataFrame, list]:
    """Leaderboard of ``models`` (name: (estimator, grid)) and the keys of the units that had to run.

    Both tables need a ``features`` vector. A grid is searched by folds; the best cell is then fitted on all training rows
    and measured on ``test``. A folder belongs to one pair of tables: it knows units by name, cell, parameters and fold.
    """
    spark = train.sparkSession
    folded = with_folds(train, key_cols, folds, seed)
    with training_rows(folded, ["features", label, FOLD]) as rows, training_rows(test, ["features", label]) as held:
        def unit(estimator, params, fit_rows, on):
            def run():
                report = metrics.regression_report(estimator.fit(fit_rows, params).transform(on), label).first()
                return report["rmse"], report["accuracy"]
            return run
        units = {}
        for name, (estimator, values) in models.items():
            for cell, text, params in _cells(estimator, values) if values else []:
                for fold in range(folds):
                    units[name, cell, text, fold] = unit(estimator, params, rows.filter(F.col(FOLD) != fold), rows.filter(F.col(FOLD) == fold))
        ran = run_pending(spark, folder, units, parallelism)
        mean = finished(spark, folder).filter(F.col("fold") != FINAL).groupBy("model", "cell", "params").agg(F.avg("rmse").alias("rmse"))
        scores = {(r["model"], r["cell"], r["params"]): r["rmse"] for r in mean.collect()}
        last = {}
        for name, (estimator, values) in models.items():
            cells = _cells(estimator, values)
            cell, text, params = min(cells, key=lambda c: (scores.get((name, c[0], c[1]), math.inf), c[0]))
            last[name, cell, text, FINAL] = unit(estimator, params, rows, held)
        ran += run_pending(spark, folder, last, parallelism)
    wanted = spark.createDataFrame([key[:3] for key in last], "model string, cell int, params string")
    board = finished(spark, folder).filter(F.col("fold") == FINAL).join(wanted, ["model", "cell", "params"], "left_semi")
    return board.select("model", "rmse", "accuracy", "params", "status"), ran
