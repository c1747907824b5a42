"""Joins in which single keys may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrasift.session import stage_table

HOT_ROWS = 1_000    # rows of one key that need no dealing
HOT_KEYS = 10_000   # a key is hot from this fraction of the rows on, so there are no more hot keys than that


def spread_join(left: DataFrame, right: DataFrame, on, how: str = "inner", hot_rows: int | None = None,
                counts: DataFrame | None = None) -> DataFrame:
    """Join ``left``, which is read twice unless ``counts`` has its keys with their ``_rows``, with ``right``, splitting hot keys of ``left``.

    Keys with more rows than ``hot_rows`` and than the ``HOT_KEYS``-th part of all are dealt
    over several parts, and their rows of ``right`` are repeated for each part. There are at
    most ``HOT_KEYS`` of them, so their list, and it alone, is broadcast. Null keys match nothing.
    """
    if counts is None:
        counts = stage_table(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    limit = max(hot_rows or HOT_ROWS, total // HOT_KEYS)
    hot = F.broadcast(counts.filter(F.col("_rows") > limit).select(*on, F.ceil(F.col("_rows") / limit).cast("long").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    dealt = left.join(hot, on, "left").withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts)).drop("_parts")
    every = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return dealt.join(every, [*on, "_part"], how).drop("_part")
