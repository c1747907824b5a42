"""Process only files that arrived since the last run.

The batch jobs skip finished work with an anti-join on paths; over millions of
files the file source's checkpoint does the same without listing the output.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrasift.operators import pixels, quality
from terrasift.registry import IMAGE_EXTENSIONS
from terrasift.sources.images import flatten_image

IMAGE_SCHEMA = ("image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>")


def _run_available(writer, target: str, checkpoint: str) -> None:
    query = (writer.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(target))
    query.awaitTermination()


def preprocess_new_images(spark: SparkSession, source: str, target: str, checkpoint: str,
                          options=pixels.ImageOptions(), files_per_batch=10_000) -> None:
    """Preprocess images not seen by an earlier run and append them to ``target``."""
    stream = (spark.readStream.format("image").schema(IMAGE_SCHEMA).option("dropInvalid", True)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(IMAGE_EXTENSIONS) + "}")
              .option("maxFilesPerTrigger", files_per_batch).load(source))
    _run_available(pixels.preprocess(flatten_image(stream), options).writeStream, target, checkpoint)


def clean_new_tables(spark: SparkSession, source: str, target: str, checkpoint: str, schema, columns,
                     files_per_batch=1_000) -> None:
    """Cast and clean CSV files not seen by an earlier run and append them to ``target``."""
    stream = (spark.readStream.schema(schema).option("header", True)
              .option("maxFilesPerTrigger", files_per_batch).csv(source))
    clean = quality.drop_missing(quality.cast_columns(stream, columns), list(columns))
    _run_available(clean.writeStream, target, checkpoint)
