import numpy as np
import pytest

from terrasift.operators import models, trees
from terrasift.operators.features import assemble

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = x[:, 0] * 3 + np.where(x[:, 1] > 0, 2.0, 0.0) + rng.normal(size=600) * 0.2
    return assemble(spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double"), COLUMNS, "features")


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted"])
def test_nodes_paths_and_importance(spark, rows, tmp_path, kind):
    estimator = {"tree": models.decision_tree("y", maxDepth=4), "forest": models.random_forest("y", numTrees=4, maxDepth=3),
                 "boosted": models.boosted_trees("y", maxIter=3, maxDepth=2)}[kind]
    model = models.fit(estimator, rows)
    models.save_model(model, str(tmp_path / "m"))
    found = trees.with_paths(trees.node_table(spark, str(tmp_path / "m"), COLUMNS))
    nodes = {(r.tree, r.path): r for r in found.collect()}
    assert len(nodes) == (model.numNodes if kind == "tree" else model.totalNumNodes)
    for (tree, path), r in nodes.items():
        assert r.depth == len(path)
        if r.left is not None:
            assert nodes[tree, path + "L"].id == r.left and nodes[tree, path + "R"].id == r.right and r.threshold is not None
        else:
            assert r.feature is None and r.gain is None
    if kind == "tree":
        assert nodes[0, ""].support == 600
        row = rows.first()
        path, at = "", nodes[0, ""]
        while at.left is not None:
            path += "L" if row[at.feature] <= at.threshold else "R"
            at = nodes[0, path]
        assert at.prediction == pytest.approx(model.predict(row.features))
    if kind != "boosted":  # boosted trees are weighted
        got = {r.feature: r.importance for r in trees.gain_importance(found).collect()}
        want = dict(zip(COLUMNS, model.featureImportances.toArray()))
        assert got == pytest.approx({k: v for k, v in want.items() if k in got}, rel=0.02)
