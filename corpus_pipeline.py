"""The training corpus in five stages, each a Spark job over what the stage before kept.

Every stage gets (spark, docs, sf_dir) and returns the columns of ``documents``;
the last adds ``copy``, the number of the copy that the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import staged, table
from terrasift.llm.contamination import without_contamination
from terrasift.llm.mixing import mixed_documents
from terrasift.llm.ranking import keep_good
from terrasift.llm.secrets import mask_secrets
from terrasift.llm.simhash import keep_first

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least id."""
    return keep_first(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` follows the text."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixed_documents(docs).select(*COLUMNS, "copy")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("mixing", mixing)]

# Trained models and a hash that SQL does not have decide; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
