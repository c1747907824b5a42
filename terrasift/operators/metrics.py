"""Regression and classification measures as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrasift.functions.numeric import is_missing, quoted, true_share, within
from terrasift.operators.quality import require_columns
from terrasift.operators.ranks import running_totals
from terrasift.registry import IMAGE_CLASSES, UNKNOWN_LABEL
from terrasift.session import stage_table

# Tolerance of the regression accuracy.
TOLERANCE = 0.5
# End of fixed values.


def _square_error(label, prediction):
    return F.pow(quoted(label) - quoted(prediction), F.lit(2.0))


def rmse(df: DataFrame, label: str, prediction="prediction") -> DataFrame:
    return df.agg(F.sqrt(F.avg(_square_error(label, prediction))).alias("rmse"))


def _both_present(df, label, prediction):
    types = {f.name: f.dataType for f in df.schema.fields}
    return ~is_missing(label, types[label]) & ~is_missing(prediction, types[prediction])


def within_threshold(df: DataFrame, label: str, prediction="prediction", threshold=TOLERANCE) -> DataFrame:
    """Correct, total and share of rows off by at most ``threshold``; 0.0 when there are none."""
    hit = F.when(_both_present(df, label, prediction), within(quoted(label), quoted(prediction), threshold))
    return df.agg(F.count_if(hit).alias("correct"), F.count(hit).alias("total"),
                  F.coalesce(true_share(hit), F.lit(0.0)).alias("accuracy"))


def regression_report(df: DataFrame, label: str, prediction="prediction", threshold=TOLERANCE) -> DataFrame:
    """RMSE and within-threshold accuracy from the same scan, with all rows and those both rest on."""
    hit = F.when(_both_present(df, label, prediction), within(quoted(label), quoted(prediction), threshold))
    return df.agg(F.sqrt(F.avg(F.when(hit.isNotNull(), _square_error(label, prediction)))).alias("rmse"),
                  F.coalesce(true_share(hit), F.lit(0.0)).alias("accuracy"), F.count("*").alias("rows"),
                  F.count(hit).alias("usable"))


def accuracy(df: DataFrame, true: str, predicted: str) -> DataFrame:
    same = quoted(true) == quoted(predicted)
    return df.agg(F.count_if(same).alias("correct"), F.count("*").alias("total"),
                  (F.count_if(same) / F.nullif(F.count("*"), F.lit(0))).alias("accuracy"))


def accuracy_known(df: DataFrame, true: str, predicted: str, status: str | None = None) -> DataFrame:
    """Accuracy in percent over rows whose true label is known; null when none is.

    With ``status`` only rows that were classified without an error count.
    """
    usable = quoted(true) != UNKNOWN_LABEL
    if status:
        usable = usable & (quoted(status) == "ok")
    return df.agg((true_share(F.when(usable, quoted(true) == quoted(predicted))) * 100).alias("accuracy_pct"),
                  F.count_if(usable).alias("known"))


def log_loss(df: DataFrame, label_id: str, probabilities: str) -> DataFrame:
    """Mean cross-entropy; ``label_id`` is zero-based."""
    own = F.get(quoted(probabilities), quoted(label_id).cast("int"))
    return df.agg(F.avg(-F.ln(own)).alias("log_loss"))


def batch_mean_loss(df: DataFrame, label_id: str, probabilities: str, batch: str) -> DataFrame:
    """Mean of the batch means, as an epoch loss is reported."""
    own = F.get(quoted(probabilities), quoted(label_id).cast("int"))
    per_batch = df.groupBy(batch).agg(F.avg(-F.ln(own)).alias("loss"))
    return per_batch.agg(F.avg("loss").alias("mean_loss"))


def misclassified(df: DataFrame, true: str, predicted: str, path: str | None = None,
                  epoch: str | None = None) -> DataFrame:
    """Wrongly predicted rows; with ``path`` each path appears once (smallest row).

    With ``epoch`` only the last one counts, otherwise all are taken together.
    """
    if epoch:
        df = df.filter(quoted(epoch) == df.agg(F.max(quoted(epoch))).scalar())
    wrong = df.filter(quoted(true) != quoted(predicted))
    if path is None:
        return wrong
    others = [c for c in wrong.columns if c != path]
    return wrong.groupBy(path).agg(F.min(F.struct(*others)).alias("r")).select(path, "r.*")


def confusion_counts(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Non-empty cells ``(true_label, predicted, n)``: one aggregate with map-side combine."""
    require_columns(df, [true, predicted])
    return (df.groupBy(quoted(true).cast("string").alias("true_label"),
                       quoted(predicted).cast("string").alias("predicted"))
            .agg(F.count("*").alias("n")))


def _labels(cells, classes) -> DataFrame:
    found = cells.select(F.explode(F.array("true_label", "predicted")).alias("label")).filter(F.col("label").isNotNull())
    given = cells.sparkSession.createDataFrame([(c,) for c in classes], "label string")
    return found.unionByName(given).distinct()


def label_universe(df: DataFrame, true: str, predicted: str, classes=IMAGE_CLASSES) -> DataFrame:
    """Union of true, predicted and configured labels, one row each, in order."""
    return _labels(confusion_counts(df, true, predicted), classes).orderBy("label")


def heatmap_cells(df: DataFrame, true: str, predicted: str, classes=IMAGE_CLASSES) -> DataFrame:
    """Non-empty cells with positions: ``x`` of the predicted, ``y`` of the true label in the order of all labels."""
    cells = stage_table(confusion_counts(df, true, predicted), "cells")
    places = running_totals(_labels(cells, classes).withColumn("one", F.lit(1)), "label", ["one"])
    places = places.select("label", (F.col("cum_one") - 1).cast("int").alias("place"))
    rows = places.select(F.col("label").alias("true_label"), F.col("place").alias("y"))
    columns = places.select(F.col("label").alias("predicted"), F.col("place").alias("x"))
    return cells.join(rows, "true_label").join(columns, "predicted").select("x", "y", "true_label", "predicted", "n")


def confusion_matrix(df: DataFrame, true: str, predicted: str, classes=IMAGE_CLASSES) -> DataFrame:
    """Every cell of label × label as ``(true_label, predicted, n)``, zeros included."""
    return heatmap_triples(df, true, predicted, classes).select("true_label", "predicted", "n")


def heatmap_triples(df: DataFrame, true: str, predicted: str, classes=IMAGE_CLASSES) -> DataFrame:
    """The dense grid with positions: ``x`` of the predicted, ``y`` of the true label.

    The square of the labels is what a dense grid is; :func:`heatmap_cells`
    gives the non-empty cells alone. The cells are staged, so the table is
    scanned once although they give both the labels and the numbers.
    """
    cells = stage_table(confusion_counts(df, true, predicted), "cells")
    labels = _labels(cells, classes).agg(F.array_sort(F.collect_list("label")).alias("labels"))
    rows = labels.select("labels", F.posexplode("labels").alias("y", "true_label"))
    grid = rows.select("y", "true_label", F.posexplode("labels").alias("x", "predicted"))
    return (grid.join(cells, ["true_label", "predicted"], "left")
            .select("x", "y", "true_label", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def confusion_pivot(df: DataFrame, true: str, predicted: str, classes=IMAGE_CLASSES) -> DataFrame:
    """Square form: a row and a column for every label that occurs or is configured.

    The labels name the columns, so the driver needs them; cells with a null
    label have no place in the square.
    """
    cells = stage_table(confusion_counts(df, true, predicted), "cells")
    labels = _labels(cells, classes)
    names = sorted(r["label"] for r in labels.collect())
    wide = cells.groupBy("true_label").agg(
        *[F.sum(F.when(F.col("predicted") == name, F.col("n"))).alias(f"c{i}") for i, name in enumerate(names)])
    rows = labels.withColumnRenamed("label", "true_label").join(wide, "true_label", "left")
    return rows.select("true_label", *[F.coalesce(f"c{i}", F.lit(0)).cast("bigint").alias(name) for i, name in enumerate(names)])


def colour_maximum(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Largest cell, 1 when there is none."""
    cells = confusion_counts(df, true, predicted)
    return cells.agg(F.coalesce(F.max("n"), F.lit(1)).cast("bigint").alias("max_cell"))


