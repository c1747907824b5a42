"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged


SALTS = 16  # parts into which the links of one vertex are dealt where they meet its least neighbour


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """Each link (a, b) beside the least neighbour ``m`` of ``a``, a hot ``a`` dealt over several tasks."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    every = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(every, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _with_least(both.filter("b > a"), least)


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return _with_least(down, least).unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(a, b) for every linked ``a`` but the least of its component, which is ``b``.

    ``links`` has two columns of one ordered type, in any direction and with
    repeats. Every round lowers each vertex to the least vertex it can see; hot
    vertices only meet partial minima and joins that can be split. Rounds grow
    with the logarithm of the longest chain. No links give no rows.
    """
    current = staged(links.toDF("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == state or not row[0]:
            return current
        state = (row[0], row[1])
        current = staged(_small_star(_large_star(current)).filter("a <> b").distinct(), "links")
