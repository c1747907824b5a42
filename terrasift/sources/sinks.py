"""Writers. Directories of part files are the default; nothing here mutates its input."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F

from terrasift.functions.labels import class_name, parent_dir
from terrasift.registry import IMAGE_CLASSES

log = logging.getLogger(__name__)

# Column names of the prediction files.
PATH, TRUE, PRED = "图像路径", "真实值", "预测值"
INFERRED_TRUE, CONFIDENCE = "真实标签(推断)", "置信度"
# End of fixed values.


def write_csv(df: DataFrame | None, path: str, sep=",", encoding="UTF-8") -> bool:
    """Overwrite ``path`` with CSV part files; nothing is written for ``None``."""
    if df is None:
        log.warning("nothing to write to %s", path)
        return False
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    return True


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV part file, which one task writes; :func:`write_csv` writes in parallel."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def normalized_name(dataset: str) -> str:
    return f"processed_{dataset}_normalized_MinMaxScaler"


def prediction_rows(df: DataFrame, path_col="path", true_col="label_id", pred_col="prediction",
                    classes=IMAGE_CLASSES) -> DataFrame:
    """Path, true and predicted class *names* under the file's column names."""
    return df.select(F.col(path_col).alias(PATH),
                     class_name(F.col(true_col).cast("int"), classes).alias(TRUE),
                     class_name(F.col(pred_col).cast("int"), classes).alias(PRED))


def write_predictions_tsv(df: DataFrame, path: str, **columns) -> None:
    write_csv(prediction_rows(df, **columns), path, sep="\t")


def write_error_paths(df: DataFrame, path: str, path_col="path", true_col="label_id", pred_col="prediction") -> bool:
    """Paths of wrong predictions, one per line; whether there are any.

    The target is overwritten in any case, so that no earlier run's paths stay.
    """
    wrong = df.filter(F.col(true_col) != F.col(pred_col)).select(F.col(path_col).alias("value"))
    wrong.write.mode("overwrite").text(path)
    return not df.sparkSession.read.text(path).isEmpty()


def batch_rows(df: DataFrame, path_col="path", true_col="true_label", pred_col="predicted",
               confidence_col="confidence") -> DataFrame:
    return df.select(F.col(path_col).alias(PATH), F.col(true_col).alias(INFERRED_TRUE),
                     F.col(pred_col).alias(PRED), F.col(confidence_col).alias(CONFIDENCE), F.col("status"))


def write_batch_predictions(df: DataFrame, path: str, wrong_path: str) -> bool:
    """All predictions, and those that differ from the inferred label; whether any do.

    Both targets are overwritten, the second also when nothing is wrong.
    """
    rows = batch_rows(df)
    write_csv(rows, path)
    wrong = rows.filter((F.col("status") == "ok") & (F.col(INFERRED_TRUE) != F.col(PRED)))
    write_csv(wrong, wrong_path)
    return not df.sparkSession.read.schema(wrong.schema).option("header", True).csv(wrong_path).isEmpty()


def write_label_predictions(df: DataFrame, path: str, label_col: str, pred_col="prediction") -> None:
    write_csv(df.select(F.col("`" + label_col + "`"), F.col(pred_col).alias(PRED)), path)


def quarantine(wrong: DataFrame, path_col="path", existing: DataFrame | None = None) -> DataFrame:
    """Wrongly predicted rows, once per path, labelled by their directory.

    A path seen several times keeps its smallest row. With ``existing`` (a
    scan of the folder) paths that are no longer there are skipped.
    """
    others = [c for c in wrong.columns if c != path_col]
    once = wrong.groupBy(path_col).agg(F.min(F.struct(*others)).alias("r")).select(path_col, "r.*")
    if "label" not in once.columns:
        once = once.withColumn("label", parent_dir(F.col(path_col)))
    if existing is not None:
        once = once.join(existing.select(path_col), path_col, "left_semi")
    return once


def write_partitioned(df: DataFrame, path: str, *by: str, rebalance=True) -> None:
    """Parquet, one directory per value.

    Rows of one directory are brought together first, so that it gets a few
    files of the advised size and not one per task; adaptive execution splits
    the share of a value that holds much of the data over several tasks.
    """
    rows = df.hint("rebalance", *by) if rebalance else df
    rows.write.mode("overwrite").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str, rebalance=True) -> None:
    """Parquet, one directory per value, of which only those that ``df`` has rows for are replaced.

    A run that is repeated, or one over a few changed classes, leaves the same table as before and
    touches no other directory. Values without rows in ``df`` keep what they have.
    """
    rows = df.hint("rebalance", *by) if rebalance else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose key has not been written yet."""
    return inputs.join(done.select(key), key, "left_anti")
