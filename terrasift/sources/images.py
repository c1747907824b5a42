"""Image folders as tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.functions import labels
from terrasift.registry import IMAGE_CLASSES, IMAGE_EXTENSIONS
from terrasift.sources.tables import _naming_missing_path

log = logging.getLogger(__name__)


def _glob(extensions) -> str:
    return "*.{" + ",".join(extensions) + "}"


def scan_files(spark: SparkSession, path: str, extensions=IMAGE_EXTENSIONS, recursive=True) -> DataFrame:
    """One row per file: path, modificationTime, length, content.

    ``content`` is only read by queries that select it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if extensions:
        reader = reader.option("pathGlobFilter", _glob(extensions))
    return _naming_missing_path(lambda: reader.load(path), path, "image folder")


def with_class(df: DataFrame, classes=IMAGE_CLASSES, path_col="path") -> DataFrame:
    """Add ``label`` (name of the directory holding the file) and ``label_id``."""
    label = labels.parent_dir(F.col(path_col))
    return df.select("*", label.alias("label"), labels.class_id(label, classes).alias("label_id"))


def scan_images(spark: SparkSession, path: str, extensions=IMAGE_EXTENSIONS, keep_invalid=False,
                recursive=True) -> DataFrame:
    """Decoded images: path, height, width, channels, mode, data (rows of BGR bytes).

    Files that cannot be decoded are skipped, or kept with ``height`` -1.
    """
    reader = (spark.read.format("image").option("dropInvalid", not keep_invalid)
              .option("recursiveFileLookup", recursive))
    if extensions:
        reader = reader.option("pathGlobFilter", _glob(extensions))
    return flatten_image(_naming_missing_path(lambda: reader.load(path), path, "image folder"))


def flatten_image(df: DataFrame) -> DataFrame:
    return df.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                     F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                     F.col("image.mode").alias("mode"), F.col("image.data").alias("data"))


def warn_if_empty(files: DataFrame, path: str, extensions=IMAGE_EXTENSIONS) -> bool:
    """Log a warning when a folder holds no file of the listed kinds."""
    empty = files.select("path").isEmpty()
    if empty:
        log.warning("no images (%s) in %s", ", ".join(extensions), path)
    return empty
