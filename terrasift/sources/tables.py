"""CSV and Parquet tables, one or many at a time."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrasift.functions.numeric import quoted

log = logging.getLogger(__name__)

BAD, FILE = "_bad", "_file"


def read_csv(spark: SparkSession, path: str, schema=None, encoding="utf-8", sep=",",
             name: str | None = None) -> DataFrame:
    """CSV file or directory of part files with a header row.

    Give ``schema`` for large inputs: without it Spark reads everything once
    more to infer types.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return _naming_missing_path(lambda: reader.csv(path), path, name)


def read_checked(spark: SparkSession, path: str, schema: str, encoding="utf-8", sep=",", header=True, name: str | None = None) -> DataFrame:
    """CSV by a given schema (DDL), with ``_bad``, the text of a line that does not fit it, and ``_file``, where it stands.

    Lines with bad values or another number of fields keep what can be read; nothing is dropped.
    """
    reader = (spark.read.option("header", header).option("encoding", encoding).option("sep", sep).option("mode", "PERMISSIVE")
              .option("enforceSchema", True).option("columnNameOfCorruptRecord", BAD).schema(f"{schema}, {BAD} string"))
    read = _naming_missing_path(lambda: reader.csv(path), path, name)
    return read.withColumn(FILE, F.col("_metadata.file_name"))


def bad_record_accounting(checked: DataFrame) -> DataFrame:
    """Per file: ``rows``, ``bad_rows``, the smallest bad line as ``example``, and ``read_values``, the values of all
    columns that could be read; files without rows do not appear. A line is only judged by columns that are read."""
    filled = [F.when(quoted(c).isNotNull(), 1).otherwise(0) for c in checked.columns if c not in (BAD, FILE)]
    return checked.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(BAD).isNotNull()).alias("bad_rows"), F.min(BAD).alias("example"),
        F.sum(sum(filled, F.lit(0))).alias("read_values"))


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    return _naming_missing_path(lambda: spark.read.parquet(path), path, name)


def _naming_missing_path(load, path, name):
    try:
        return load()
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{name or 'table'}: no such path {path}") from err
        raise


def ingest_all(spark: SparkSession, loaders: dict, accounting) -> DataFrame:
    """Load many datasets; a failing one gets a status row, the rest go on.

    ``loaders`` maps a name to a function returning a DataFrame, ``accounting``
    turns that DataFrame into one row of counts. Datasets are independent jobs
    and are submitted together; only their counts reach the driver.
    """
    def one(name):
        try:
            row = accounting(loaders[name]()).first()
            return (name, row["rows_before"], row["rows_after"], row["rows_dropped"], "ok")
        except (PySparkException, Py4JJavaError, OSError, ValueError) as err:
            log.error("dataset %s skipped: %s", name, err)
            return (name, None, None, None, "failed")

    with ThreadPoolExecutor(max_workers=min(8, max(1, len(loaders)))) as pool:
        rows = list(pool.map(one, loaders))
    return spark.createDataFrame(
        rows, "dataset string, rows_before bigint, rows_after bigint, rows_dropped bigint, status string")
