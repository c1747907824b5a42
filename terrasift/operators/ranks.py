"""Exact ranks and running totals without putting a whole group into one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from terrasift.session import stage_table

HASH_DIGITS = 32        # of the leading md5 in hex
ROWS_PER_BUCKET = 1_000_000


def hash_thresholds(hashed: DataFrame, strata, cuts, digits=4, rows_per_bucket=ROWS_PER_BUCKET) -> DataFrame:
    """Per stratum, the hash values that cut its hash order at exact ranks.

    ``hashed`` has the stratum columns and ``h`` (hex text); ``cuts`` maps the
    stratum's row count to rank columns. Output: strata plus ``t<i>``, ``k<i>``
    and ``m<i>``: below cut ``i`` are the rows with ``h < t<i>`` and ``k<i>`` of
    the ``m<i>`` rows with ``h = t<i>``.

    ``digits`` more hex digits split the bucket of each cut in every step, until
    the buckets hold at most ``rows_per_bucket`` rows: a step scans the hashes
    and counts, so no group is ever sorted as a whole, however large.
    """
    n_cuts, length = len(cuts(F.lit(0))), digits
    per_stratum = Window.partitionBy(*strata)
    counts = hashed.groupBy(*strata, F.substring("h", 1, length).alias("b")).agg(F.count("*").alias("n"))
    running = counts.select(
        *strata, "b", "n", (F.sum("n").over(per_stratum.orderBy("b")) - F.col("n")).alias("before"),
        F.sum("n").over(per_stratum).alias("total"))
    cut_list = F.array(*[c.cast("long") for c in cuts(F.col("total"))])
    edges = (running.select(*strata, "b", "n", "before", F.posexplode(cut_list).alias("i", "rank"))
             .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n"))))
    while True:
        # At most one row per stratum and cut; staged so that its size is known and
        # the join below is a broadcast exactly when it is small.
        edges = stage_table(edges, "cut-buckets")
        largest = edges.agg(F.max("n")).first()[0] or 0
        whole = largest <= rows_per_bucket or length >= HASH_DIGITS
        part = F.col("h") if whole else F.substring("h", 1, length + digits)
        bucketed = hashed.select(*strata, F.substring("h", 1, length).alias("b"), part.alias("c"))
        near = (bucketed.alias("l").join(edges.alias("r"), _matching([*strata, "b"]))
                .groupBy(*[F.col(f"r.{c}") for c in strata], "i", "rank", "before", "c").agg(F.count("*").alias("n")))
        inside = Window.partitionBy(*strata, "i").orderBy("c")
        starts = near.select(*strata, "i", "rank", "c", "n", (F.col("before") + F.sum("n").over(inside) - F.col("n")).alias("start"))
        chosen = starts.filter((F.col("start") < F.col("rank")) & (F.col("rank") <= F.col("start") + F.col("n")))
        if whole:
            break
        edges = chosen.select(*strata, F.col("c").alias("b"), "n", F.col("start").alias("before"), "i", "rank")
        length += digits
    return chosen.groupBy(*strata).agg(*[
        F.max(F.when(F.col("i") == i, value)).alias(f"{name}{i}") for i in range(n_cuts)
        for name, value in (("t", F.col("c")), ("k", F.col("rank") - F.col("start")), ("m", F.col("n")))])


def _matching(columns, left="l", right="r"):
    """Equality of the columns in two aliased tables; nulls match nulls."""
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


def numbered(df: DataFrame, by) -> DataFrame:
    """Add ``number`` from 1 within equal values of ``by``, in no stated order.

    Rows are numbered where they lie and each part starts after the parts
    before it, so equal rows need not meet in one task.
    """
    parts = stage_table(df.withColumn("_part", F.spark_partition_id()), "numbered")
    counts = parts.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_part").orderBy(F.lit(1))
    rows = parts.withColumn("_place", F.row_number().over(inside)).alias("l").join(starts.alias("r"), _matching([*by, "_part"]))
    return rows.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._place") + F.col("r._start")).alias("number"))


def running_totals(df: DataFrame, order_col: str, sums, groups=(), ascending=True, ranges=None) -> DataFrame:
    """Add ``cum_<s>`` and ``all_<s>`` for every column in ``sums``.

    ``df`` must hold one row per group and order value (aggregate first, so
    that a value shared by a third of the input is one row) of any ordered
    type. It is dealt into ``ranges`` of the order (the shuffle partitions, if
    not given); each range is summed and ordered by its own task and starts from
    the totals of the ranges before it, so the result is exact wherever the
    ranges end. Only those totals, one row per range and group, meet.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    dealt = df.repartitionByRange(ranges, *[F.col(g).asc() for g in groups], order)
    table = stage_table(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = table.groupBy(*groups, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_range").alias("_part"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"all_{s}") for s in sums])
    # One exchange by range serves the window and the join: the groups, which may be null, are compared apart from the key.
    inside = Window.partitionBy("_range", *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = table.repartition(ranges, "_range").select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    same = F.col("_range") == F.col("_part")
    for i, g in enumerate(groups):
        same = same & ((F.col(g) == F.col(f"_g{i}")) | (F.col(g).isNull() & F.col(f"_g{i}").isNull()))
    joined = local.join(offsets, same)
    return joined.select(*df.columns, *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
                         *[F.col(f"all_{s}") for s in sums])


def exact_quantiles(df: DataFrame, value_col: str, probs, groups=(), ranges=None) -> DataFrame:
    """Linear-interpolated quantiles ``q0, q1, …`` per group, exact at any size.

    Values are counted first (copies of one value collapse before the shuffle);
    the order statistics are then found from running counts, so no group's
    values are collected.
    """
    valued = df.filter(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col).cast("double")))
    counted = valued.groupBy(*groups, value_col).agg(F.count("*").alias("n"))
    ranked = running_totals(counted, value_col, ["n"], groups, ranges=ranges)
    picks = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("all_n") - 1)
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            holds = (F.col("cum_n") > at) & (F.col("cum_n") - F.col("n") <= at)
            picks.append(F.max(F.when(holds, F.col(value_col))).alias(f"_{side}{i}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_w{i}"))
    found = ranked.groupBy(*groups).agg(F.max("all_n").alias("n"), F.min(value_col).alias("min"),
                                        F.max(value_col).alias("max"), *picks)
    return found.select(
        *groups, "n", "min", "max",
        *[(F.col(f"_lo{i}") + F.col(f"_w{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
          for i in range(len(probs))])
