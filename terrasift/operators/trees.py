"""Fitted trees as tables, read from the node table of a saved model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

NODES = "id, leftChild, rightChild, split, prediction, impurity, gain, rawCount"


def node_table(spark: SparkSession, path: str, feature_names=None) -> DataFrame:
    """One row per node of a saved tree, forest or boosted model.

    ``tree``, ``id``, ``left`` and ``right`` (null in leaves), ``feature`` and ``threshold`` of the split (left: at most the
    threshold), ``prediction``, ``impurity``, ``gain`` and ``support``, the rows that reached the node in training.
    Splits by category keep a null threshold.
    """
    saved = spark.read.parquet(f"{path.rstrip('/')}/data")
    nodes = (saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in saved.columns
             else saved.select(F.lit(0).alias("tree"), "*"))
    index = F.col("split.featureIndex")
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(n) for n in feature_names]) if feature_names else None
    feature = F.get(names, index) if names is not None else F.concat(F.lit("feature "), index.cast("string"))
    continuous = inner & (F.col("split.numCategories") < 0)
    return nodes.select(
        "tree", "id", F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, feature).alias("feature"), F.when(continuous, F.get("split.leftCategoriesOrThreshold", 0)).alias("threshold"),
        "prediction", "impurity", F.when(inner, F.col("gain")).alias("gain"), F.col("rawCount").alias("support"))


def with_paths(nodes: DataFrame) -> DataFrame:
    """Add ``depth`` and ``path``, the turns (``L``, ``R``) from the root, by recursion over the levels of all trees at once."""
    return nodes.sparkSession.sql("""
        WITH RECURSIVE walk(tree, id, depth, path) AS (
          SELECT tree, id, 0, CAST('' AS STRING) FROM {nodes} WHERE id = 0
          UNION ALL
          SELECT n.tree, turn.child, w.depth + 1, concat(w.path, turn.side)
          FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.id = w.id
          LATERAL VIEW inline(array(struct(n.left AS child, 'L' AS side), struct(n.right AS child, 'R' AS side))) turn
          WHERE n.left IS NOT NULL)
        SELECT n.*, w.depth, w.path FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.id = w.id""", nodes=nodes)


def gain_importance(nodes: DataFrame) -> DataFrame:
    """feature, importance: gains weighted by support, as shares of each tree and then of all trees."""
    gains = nodes.filter("gain IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("support")).alias("g"))
    whole = gains.groupBy("tree").agg(F.sum("g").alias("all"))
    shares = gains.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.nullif(F.col("all"), F.lit(0.0))).alias("s"))
    return shares.select("feature", (F.col("s") / shares.agg(F.sum("s")).scalar()).alias("importance"))
