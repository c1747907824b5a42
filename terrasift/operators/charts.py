"""The data behind the usual charts; nothing is drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrasift.functions.hashing import row_hash, unit_interval
from terrasift.functions.numeric import quoted
from terrasift.operators.ranks import exact_quantiles, running_totals
from terrasift.session import stage_table


def scatter(df: DataFrame, x: str, y: str, key_cols=None, share=1.0) -> DataFrame:
    """Points; ``share`` below 1 keeps a reproducible sample by key."""
    if share < 1.0:
        df = df.filter(unit_interval(row_hash(key_cols, 0)) < share)
    return df.select(quoted(x).alias("x"), quoted(y).alias("y"))


def histogram(df: DataFrame, column: str, bins=10) -> DataFrame:
    """Equal-width bins over the column's finite range, empty bins included.

    Infinities have no place in a bin; they are counted in two more rows, -1
    from minus infinity and ``bins`` to plus infinity, which appear only if any
    value is infinite. Nulls and NaN are left out.
    """
    value = quoted(column).cast("double")
    valued = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    above, below = F.col("v") == float("inf"), F.col("v") == float("-inf")
    finite = F.when(~above & ~below, F.col("v"))
    edges = valued.agg(F.struct(F.min(finite).alias("lo"), F.max(finite).alias("hi")).alias("e")).scalar()
    lo, width = F.col("e.lo"), F.col("e.hi") - F.col("e.lo")
    slot = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / width * bins)))
    place = F.when(above, F.lit(bins)).when(below, F.lit(-1)).otherwise(F.coalesce(slot, F.lit(0))).cast("bigint")
    counts = valued.select("v", edges.alias("e")).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(-1, bins + 1).select(F.col("id").alias("bin"), edges.alias("e"))
    outer = (F.col("bin") == -1) | (F.col("bin") == bins)
    lower = F.when(F.col("bin") == -1, F.lit(float("-inf"))).when(F.col("bin") == bins, F.col("e.hi")).otherwise(lo + F.col("bin") * width / bins)
    upper = F.when(F.col("bin") == -1, lo).when(F.col("bin") == bins, F.lit(float("inf"))).otherwise(lo + (F.col("bin") + 1) * width / bins)
    return (every.join(counts, "bin", "left").filter(~outer | F.col("n").isNotNull())
            .select("bin", lower.alias("lower"), upper.alias("upper"), F.coalesce("n", F.lit(0)).alias("n")))


def box_stats(df: DataFrame, value: str, by: str, reach=1.5, **options) -> DataFrame:
    """Quartiles, whisker ends (last value within ``reach``·IQR) and outliers per group.

    Whiskers need the quartiles first: the second scan joins one row per group.
    """
    quart = exact_quantiles(df, value, [0.25, 0.5, 0.75], [by], **options)
    # One row per group, staged so that its join is a broadcast exactly when it is small.
    stats = stage_table(quart.select(by, "n", "min", "max", F.col("q0").alias("q1"), F.col("q1").alias("median"),
                                     F.col("q2").alias("q3")), "quartiles")
    spread = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - reach * spread, F.col("q3") + reach * spread)
    limits = stats.select(F.col(by).alias("_by"), "q1", "q3")
    ends = (df.select(by, value).filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
            .join(limits, F.col(by).eqNullSafe(F.col("_by")))
            .groupBy("_by").agg(F.min(F.when(inside, F.col(value))).alias("whisker_low"),
                                F.max(F.when(inside, F.col(value))).alias("whisker_high"),
                                F.count_if(~inside).alias("outliers")))
    return stats.join(ends, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def line(df: DataFrame, time_col: str, value: str, unit="month") -> DataFrame:
    """Rows, sum and mean of ``value`` per calendar unit."""
    return df.groupBy(F.date_trunc(unit, F.col(time_col)).alias("period")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))


def bar(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(quoted(category).alias("category")).agg(F.count("*").alias("n"))


def roc_points(df: DataFrame, score: str, label: str, ranges=None) -> DataFrame:
    """One point per distinct score, highest first: ``score, tp, fp, tpr, fpr``.

    Rows are counted per score before anything is ordered.
    """
    counted = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
               .groupBy(F.col(score).alias("score"))
               .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    curve = running_totals(counted, "score", ["pos", "neg"], ascending=False, ranges=ranges)
    return curve.select("score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                        (F.col("cum_pos") / F.nullif(F.col("all_pos"), F.lit(0))).alias("tpr"),
                        (F.col("cum_neg") / F.nullif(F.col("all_neg"), F.lit(0))).alias("fpr"))


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the curve by trapezoids.

    A step's trapezoid needs only its own row: it is the step's share of
    negatives times the mean of the true-positive rate before and after.
    """
    area = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return points.agg((F.sum(area) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def residuals(scored: DataFrame, label: str, prediction="prediction", keep=()) -> DataFrame:
    return scored.select(*[quoted(c) for c in keep], quoted(prediction).alias("predicted"),
                         (quoted(label) - quoted(prediction)).alias("residual"))


def predicted_vs_actual(scored: DataFrame, label: str, prediction="prediction", keep=()) -> DataFrame:
    return scored.select(*[quoted(c) for c in keep], quoted(label).alias("actual"),
                         quoted(prediction).alias("predicted"))


def tree_rules(spark, model, feature_names=None) -> DataFrame:
    """The tree as rows in print order: depth, condition or leaf, and its numbers.

    ``kind`` is ``if``, ``else`` or ``leaf``; conditions have ``feature`` and
    ``threshold`` (left branch: at most the threshold), leaves ``prediction``.
    """
    lines = [text for text in model.toDebugString.split("\n")[1:] if text.strip()]
    printed = spark.createDataFrame(list(enumerate(lines)), "line int, rule string")
    kind = F.lower(F.regexp_extract("rule", r"^\s*(If|Else|Predict)", 1))
    index = F.nullif(F.regexp_extract("rule", r"feature (\d+)", 1), F.lit("")).cast("int")
    names = F.array(*[F.lit(n) for n in feature_names]) if feature_names else None
    number = r"([-+0-9.Ee]+)"
    return printed.select(
        "line", (F.length("rule") - F.length(F.ltrim("rule")) - 2).alias("depth"),
        F.when(kind == "predict", "leaf").otherwise(kind).alias("kind"),
        (F.get(names, index) if names is not None else F.concat(F.lit("feature "), index)).alias("feature"),
        F.regexp_extract("rule", r"(?:<=|>) " + number, 1).try_cast("double").alias("threshold"),
        F.regexp_extract("rule", "Predict: " + number, 1).try_cast("double").alias("prediction"))


def feature_importance(spark, model, feature_names) -> DataFrame:
    weights = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(w)) for n, w in zip(feature_names, weights)],
                                 "feature string, importance double")
