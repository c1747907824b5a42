"""Jobs on image folders: preprocess what is new, split, classify, report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.functions import labels
from terrasift.operators import classify, metrics, models, pixels, splits
from terrasift.registry import IMAGE_CLASSES, UNKNOWN_LABEL
from terrasift.session import stage_table
from terrasift.sources import images, sinks

FAILED = "Error"  # predicted class of an image that could not be classified


def preprocess_folder(spark: SparkSession, source: str, target: str, options=pixels.ImageOptions(),
                      done: DataFrame | None = None) -> DataFrame:
    """Preprocess the images of a folder that ``done`` (a table with ``path``) does not list.

    The image source decodes every file before paths can be compared; for a
    large folder that grows, :func:`terrasift.streaming.incremental.preprocess_new_images`
    reads new files only.
    """
    images.warn_if_empty(images.scan_files(spark, source), source)
    todo = images.scan_images(spark, source)
    if done is not None:
        todo = sinks.pending(todo, done, "path")
    pixels.preprocess(todo, options).write.mode("append").parquet(target)
    return spark.read.parquet(target)


def split_folder(files: DataFrame, target: str | None = None, **shares) -> DataFrame:
    """Stratified split of an image list by class; optionally written per split and class."""
    out = splits.stratified_split(files, "label", ["path"], **shares)
    if target:
        sinks.write_partitioned(out, target, "split", "label")
    return out


def train_classifier(images_table: DataFrame, options=pixels.ImageOptions(feature_size=pixels.FEATURE_SIZE),
                     label="label_id", key="path", **fit_options) -> tuple:
    """Preprocess, split by class, train on the train rows, score the rest.

    ``images_table`` has ``path``, pixels and ``label_id``. Features are staged,
    so no image is processed twice. Returns ``(model, scored test rows)``.
    """
    chosen = replace(options, keep_pixels=False, carry=(label,))
    ready = stage_table(pixels.preprocess(images_table, chosen).filter(F.col("status") == "ok"), "image-features")
    parts = splits.stratified_split(ready.select(key, label, "features"), label, [key])
    model = classify.fit_classifier(parts.filter(F.col("split") == "train"), "features", label, **fit_options)
    held_out = parts.filter(F.col("split") == "test")
    return model, classify.classify(held_out, model, "features", keep=[key, label])


def classify_images(features: DataFrame, model, classes=IMAGE_CLASSES, label_mode="parent_dir") -> DataFrame:
    """Batch predictions with the label implied by each path."""
    scored = classify.classify(features, model, "features", keep=["path"])
    return scored.select(
        "path", labels.label_from_path(F.col("path"), classes, label_mode).alias("true_label"),
        labels.class_name(F.col("prediction"), classes).alias("predicted"), "confidence",
        F.lit("ok").alias("status"))


def predict_folder(spark: SparkSession, source: str, model, target: str,
                   options=pixels.ImageOptions(feature_size=pixels.FEATURE_SIZE), classes=IMAGE_CLASSES,
                   label_mode="parent_dir") -> tuple:
    """Classify every image of a folder with a fitted or saved model.

    ``model`` is a model or the path of one. Files that cannot be decoded or
    processed stay in the result as error rows. Writes all predictions
    (tab-separated) and the paths of the wrong ones below ``target`` and returns
    ``(predictions, accuracy)``, both DataFrames.
    """
    fitted = models.load_model(model) if isinstance(model, str) else model
    decoded = images.scan_images(spark, source, keep_invalid=True)
    ready = pixels.preprocess(decoded.filter("height > 0"), replace(options, keep_pixels=False))
    ready = stage_table(ready.select("path", "status", "features"), "image-features")
    failed = decoded.filter("height <= 0").select("path").unionByName(ready.filter("status <> 'ok'").select("path"))
    errors = failed.select(
        "path", labels.label_from_path(F.col("path"), classes, label_mode).alias("true_label"),
        F.lit(FAILED).alias("predicted"), F.lit(None).cast("double").alias("confidence"), F.lit("error").alias("status"))
    scored = classify_images(ready.filter("status = 'ok'"), fitted, classes, label_mode)
    rows = stage_table(scored.unionByName(errors), "predictions")
    sinks.write_csv(sinks.batch_rows(rows), f"{target}/predictions", sep="\t")
    judged = rows.filter((F.col("status") == "ok") & (F.col("true_label") != UNKNOWN_LABEL))
    sinks.write_error_paths(judged, f"{target}/wrong_paths", true_col="true_label", pred_col="predicted")
    return rows, metrics.accuracy_known(rows, "true_label", "predicted", "status")


def report(predictions: DataFrame, classes=IMAGE_CLASSES) -> dict:
    """Accuracy, confusion cells and wrong rows of a prediction table."""
    return {
        "accuracy": metrics.accuracy_known(predictions, "true_label", "predicted", "status"),
        "confusion": metrics.heatmap_triples(predictions, "true_label", "predicted", classes),
        "wrong": metrics.misclassified(predictions, "true_label", "predicted", "path"),
    }
