"""Profiles merged from batches."""

from pyspark.sql import functions as F

from terrasift.operators import profiles
from terrasift.plans.catalog import query, table
from terrasift.session import stage_table

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("merged_profiles", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*)::BIGINT AS rows, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most, round(sum({c}::DOUBLE), 2) AS total,
 true AS median_in_bound, true AS distincts_in_bound FROM lineitem""" for c in COLUMNS))
def merged_profiles(spark, folder):
    """Profiles of the batches by line number, stored and merged; the sketches are held against the exact ranks and counts."""
    items = table(spark, folder, "lineitem").select("l_linenumber", *COLUMNS)
    stored = stage_table(profiles.batch_profiles(items, COLUMNS, "l_linenumber"), "profiles")
    found = stage_table(profiles.merged_profiles(stored), "merged").withColumn("median", F.col("quantiles")[1])
    long = items.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in COLUMNS])))
    # One row for each column is joined.
    ranks = long.join(F.broadcast(found.select("column", "median")), "column").groupBy("column").agg(
        F.avg((F.col("v") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("median")).cast("double")).alias("upto"),
        F.count_distinct("v").alias("exact"))
    bound = profiles.RANK_ERROR
    return found.join(ranks, "column").select(
        "column", "rows", "least", "most", F.round(F.col("mean") * (F.col("rows") - F.col("nulls")), 2).alias("total"),
        ((F.col("below") <= 0.5 + bound) & (F.col("upto") >= 0.5 - bound)).alias("median_in_bound"),
        (F.abs(F.col("distincts") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * profiles.DISTINCT_ERROR)).alias("distincts_in_bound"))
