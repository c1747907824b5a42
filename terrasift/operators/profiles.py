"""Column profiles that add up: stored per batch, merged without reading the rows again.

A batch leaves one row per column with counts, extremes and sum, a quantile sketch
(KLL) and a distinct-count sketch (HyperLogLog). Rows of any batches merge into the
profile of all their rows, so a table that grows is profiled by its new batches alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrasift.functions.numeric import quoted
from terrasift.operators.quality import require_columns

# Sizes of the sketches, and what they are off by at most in all but about one of a hundred cases.
QUANTILE_SIZE, RANK_ERROR = 1_000, 0.01
DISTINCT_BITS, DISTINCT_ERROR = 14, 0.03
# End of fixed values.


def batch_profiles(df: DataFrame, columns, batch: str) -> DataFrame:
    """batch, column, rows, nulls, least, most, total and the two sketches of each numeric column, from one aggregate."""
    columns = list(columns)
    require_columns(df, [*columns, batch])
    values = df.select(quoted(batch).alias("batch"), *[quoted(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)])
    aggregates = []
    for k in range(len(columns)):
        v = f"v{k}"
        aggregates += [
            F.count_if(F.col(v).isNull()).alias(f"nulls{k}"), F.min(v).alias(f"least{k}"), F.max(v).alias(f"most{k}"), F.sum(v).alias(f"total{k}"),
            F.expr(f"kll_sketch_agg_double({v}, {QUANTILE_SIZE})").alias(f"quantiles{k}"),
            # Doubles are told apart by their bits, as the sketch takes whole numbers.
            F.hll_sketch_agg(F.xxhash64(v), DISTINCT_BITS).alias(f"distincts{k}")]
    wide = values.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    names = ("nulls", "least", "most", "total", "quantiles", "distincts")
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{k}").alias(name) for name in names]) for k, c in enumerate(columns)]
    return wide.select("batch", "rows", F.inline(F.array(*rows)))


def merged_profiles(profiles: DataFrame, levels=(0.25, 0.5, 0.75)) -> DataFrame:
    """column, rows, nulls, least, most, mean, distincts and ``quantiles`` at ``levels``, of all batches together.

    A null counts as one distinct value, where there are any. Quantiles are within ``RANK_ERROR`` of their rank.
    """
    merged = profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.sum("total").alias("total"), F.expr("kll_merge_agg_double(quantiles)").alias("sketch"), F.hll_union_agg("distincts").alias("values"))
    wanted = F.array(*[F.lit(float(x)) for x in levels])
    filled = F.col("rows") - F.col("nulls")
    found = F.when(filled > 0, F.call_function("kll_sketch_get_quantile_double", "sketch", wanted))
    return merged.select("column", "rows", "nulls", "least", "most", (F.col("total") / F.nullif(filled, F.lit(0))).alias("mean"),
                         F.hll_sketch_estimate("values").alias("distincts"), found.alias("quantiles"))
