"""Words, staging and ordering helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrasift.session import stage_table

# White space as the words of all operators know it; ``bytes.split()`` cuts at the same six characters.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs neither recompute it nor need the executors that made it."""
    return stage_table(df, f"llm-{label}")


def with_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Number rows from 0 in a total order without sorting them in one task.

    Rows are dealt into ranges of the order; only the row counts of the ranges,
    at most one for each shuffle partition, are summed in a single task.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(shuffle_partitions(spark), *order).withColumn("_range", F.spark_partition_id())
    ranges = staged(ranges, "ranges")
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (ranges.join(starts, "_range")
            .withColumn(name, (F.col("_start") + F.row_number().over(inside) - 1).cast("long"))
            .drop("_range", "_start"))


HOT_ROWS = 5_000    # rows of one key that need no dealing
HOT_KEYS = 10_000   # keys that can be dealt; a key is hot from this fraction of the rows on, so there are no more of them


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", counts: DataFrame | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join in which one key may hold any share of ``left`` (staged, as it is read twice).

    Keys with more rows than ``hot_rows`` and than the ``HOT_KEYS``-th part of all are dealt
    over several parts, and their rows of ``right`` are repeated for each part. There are at
    most ``HOT_KEYS`` of them, so their list, and it alone, is broadcast. Null keys match nothing.
    ``counts`` (the key and ``_rows``), where it is known already, saves counting.
    """
    limit = max(hot_rows, left.count() // HOT_KEYS)
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")) if counts is None else counts
    counts = counts.filter(F.col("_rows") > limit)
    hot = F.broadcast(staged(counts.select(*on, F.ceil(F.col("_rows") / limit).cast("long").alias("_parts")), "hot"))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    dealt = left.join(hot, on, "left").withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts)).drop("_parts")
    every = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return dealt.join(every, [*on, "_part"], how).drop("_part")
