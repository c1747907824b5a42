"""Trees as tables."""

from pyspark.sql import functions as F

from terrasift.operators import models, trees
from terrasift.plans.catalog import query
from terrasift.plans.catalog.models import MEASURES, TWO_LEVELS, two_level_tree
from terrasift.session import scratch_path


def _nodes(spark, folder):
    model, _ = two_level_tree(spark, folder)
    path = scratch_path(spark, "tree")
    models.save_model(model, path)
    return trees.node_table(spark, path, MEASURES)


@query("tree_nodes", TWO_LEVELS + """
, sizes AS (SELECT 1 AS node, count(*) AS support FROM items UNION ALL SELECT node, count(*) FROM side GROUP BY node)
SELECT CASE node WHEN 1 THEN '' WHEN 2 THEN 'L' ELSE 'R' END AS path, CASE node WHEN 1 THEN 0 ELSE 1 END AS depth, f AS feature, round(cut, 6) AS threshold,
 NULL::DOUBLE AS prediction, support, round(gain, 3) AS total_gain FROM picks JOIN sizes USING (node)
UNION ALL
SELECT CASE k.node WHEN 2 THEN 'L' ELSE 'R' END || CASE WHEN x <= cut THEN 'L' ELSE 'R' END, 2, NULL, NULL,
 round(any_value(CASE WHEN x <= cut THEN lo ELSE hi END), 6), count(*), NULL FROM lf2 JOIN k ON lf2.node = k.node AND lf2.f = k.f GROUP BY k.node, x <= cut""")
def tree_nodes(spark, folder):
    """All nodes of a tree of two levels with their places, splits, sizes and gains."""
    found = trees.with_paths(_nodes(spark, folder))
    return found.select("path", "depth", "feature", F.round("threshold", 6).alias("threshold"),
                        F.when(F.col("left").isNull(), F.round("prediction", 6)).alias("prediction"), "support",
                        F.round(F.col("gain") * F.col("support"), 3).alias("total_gain"))


@query("tree_gain_importance", TWO_LEVELS + """
SELECT f AS feature, round(sum(gain) / (SELECT sum(gain) FROM picks), 6) AS importance FROM picks GROUP BY f""")
def tree_gain_importance(spark, folder):
    return trees.gain_importance(_nodes(spark, folder)).withColumn("importance", F.round("importance", 6))
