import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.operators import bagging, counted, draws, fold_sums, models, splits
from terrasift.operators.features import assemble


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 9, 3000), rng.integers(0, 5, 3000), rng.normal(size=3000)
    y = a * 1.5 + (b > 2) * 4 + (c > 0) + rng.normal(size=3000) * 0.3
    data = [(k, float(p), float(q), float(r), float(v)) for k, (p, q, r, v) in enumerate(zip(a, b, c, y))]
    return assemble(spark.createDataFrame(data, "id long, a double, b double, c double, y double"), ["a", "b"], "features").cache()


def scores(df):
    return {r.id: r.prediction for r in df.collect()}


def test_boosting_on_counts_equals_boosting_on_rows(rows):
    estimator = models.boosted_trees("y", maxIter=5, maxDepth=3, minInstancesPerNode=30)
    bins = counted.settle(rows, "features", 32, 0)
    found = counted.tune(rows, bins, estimator, {}, "y", ["id"], 0, models.FOLD)
    want = scores(models.fit(estimator, rows).transform(rows))
    got = scores(found.transform(rows))
    assert got == pytest.approx(want, abs=1e-9) and len(set(np.round(list(got.values()), 6))) > 10


def test_grid_on_counts_has_the_errors_of_the_rows(rows):
    estimator, values = models.decision_tree("y"), {"maxDepth": [1, 4], "minInstancesPerNode": [1, 2000]}
    bins = counted.settle(rows, "features", 32, 0)
    folded = models.with_folds(rows, ["id"], 3)
    found = counted.tune(folded, bins, estimator, values, "y", ["id"], 3, models.FOLD)
    want = models.cross_validate(rows, estimator, values, "y", ["id"]).bestModel
    assert found.chosen == {p: want.getOrDefault(p) for p in values} == {"maxDepth": 4, "minInstancesPerNode": 1}
    assert scores(found.transform(rows)) == pytest.approx(scores(want.transform(rows)), abs=1e-9)


def test_forest_on_counts_draws_every_row(rows):
    estimator = models.random_forest("y", numTrees=8, maxDepth=4)
    bins = counted.settle(rows, "features", 32, 0)
    found = counted.tune(rows, bins, estimator, {}, "y", ["id"], 0, models.FOLD)
    drawn = {m._call_java("toDebugString") for m in found.models}
    assert len(found.models) == len(drawn) == 8
    got = found.transform(rows)
    assert got.count() == 3000 and got.columns == [*rows.columns, "prediction"]
    plain = models.fit(estimator, rows).transform(rows)

    def error(df):
        return df.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0]
    assert error(got) == pytest.approx(error(plain), rel=0.25)


def test_rows_that_share_no_bins_are_left_to_the_rows(rows):
    assert counted.settle(rows.limit(20), "features", 32, 0) is None
    assert counted.settle(rows, "features", 32) is None
    wide = counted.settle(rows, ["a", "b", "c"], 4, 0)
    assert [len(wide.cuts.get(n, [])) for n in wide.names] == [3, 3, 3]
    assert wide.add(rows).select(*wide.names).distinct().count() <= 64


def test_missing_values_are_refused_as_on_the_rows(rows):
    bins = counted.settle(rows, ["a", "b"], 4, 0)
    odd = rows.withColumn("a", F.when(F.col("id") > 0, F.col("a")))
    assert math.isnan(bins.add(odd).filter("id = 0").first()["_bin0"]) and bins.add(odd).filter("isnan(_bin0)").count() == 1
    for broken in (odd, rows.withColumn("y", F.when(F.col("id") > 0, F.col("y")))):
        with pytest.raises(Exception, match="MUST NOT be"):
            counted.tune(broken, bins, models.boosted_trees("y", maxIter=1), {}, "y", ["id"], 0, models.FOLD)


def test_hashed_forest_fits_counts_not_rows(rows, monkeypatch):
    seen, fit = [], counted.fit_rows
    monkeypatch.setattr(counted, "fit_rows", lambda bins, df, n: seen.append(df.count()) or fit(bins, df, n))
    forest = bagging.fit_hashed_forest(rows, ["a", "b"], "y", ["id"], trees=3, maxDepth=3)
    assert len(seen) == 3 and max(seen) <= 45
    monkeypatch.setattr(counted, "ROWS_PER_GROUP", math.inf)
    plain = bagging.fit_hashed_forest(rows, ["a", "b"], "y", ["id"], trees=3, maxDepth=3)
    assert scores(forest.transform(rows)) == pytest.approx(scores(plain.transform(rows)), abs=1e-9)


def test_leaderboard_fits_trees_on_counts(rows, monkeypatch):
    monkeypatch.setattr(counted, "least_rows", lambda estimator: 0)
    monkeypatch.setattr(models, "_validate", None)
    entries = {"tree": (models.decision_tree("y"), {"maxDepth": [1, 4]}), "forest": (models.random_forest("y"), {"numTrees": [2, 3]}),
               "boosted": (models.boosted_trees("y", maxIter=3, maxDepth=3), {})}
    train, test = rows.filter("id % 5 > 0"), rows.filter("id % 5 = 0")
    board = {r["model"]: r for r in models.leaderboard(train, test, entries, "y", ["id"]).collect()}
    assert {r["status"] for r in board.values()} == {"ok"} and board["tree"]["params"] == "maxDepth=4"
    assert all(r["rmse"] < 0.5 * test.agg(F.stddev_pop("y")).first()[0] for r in board.values())


def test_bags_are_summed_in_the_task_as_row_by_row(rows, monkeypatch):
    """no copy of a row leaves its task, and the draws are those of the expression."""
    monkeypatch.setattr(draws, "CHUNK_ROWS", 500)
    bins = counted.settle(rows, "features", 32, 0)
    staged = counted.bag_rows(models.with_folds(rows, ["id"], 3), bins, "y", ["id"], 42, 135, [models.FOLD])
    names, trees = [models.FOLD, *bins.names], range(3)
    drawn = draws.drawn_sums(staged, names, trees, "_tree", "_rows")
    assert drawn.count() < 3000 * 3 / 2
    got = {tuple(r[:4]): (r[4], r[5]) for r in drawn.groupBy("_tree", *names).agg(F.sum("_rows"), F.sum("_s")).collect()}
    key = counted.row_key(["id", "y"]).alias(counted.ROW_KEY)
    exploded = bins.add(models.with_folds(rows, ["id"], 3).select("*", key)).select("*", F.explode(F.array(*[F.lit(t) for t in trees])).alias("_tree"))
    weighted = exploded.withColumn("_w", counted.copies(counted.draw(42))).filter("_w > 0")
    want = {tuple(r[:4]): (r[4], r[5]) for r in weighted.groupBy("_tree", *names).agg(F.sum("_w"), F.sum(F.col("_w") * F.col("y"))).collect()}
    assert got.keys() == want.keys() and len(got) > 300
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_large_tables_are_hashed_once(rows, monkeypatch):
    """the split of a staged table is that of the table."""
    plain, staged = (splits.holdout_split(rows.select("id", "a", "y"), ["id"], staged=s) for s in (False, True))
    assert "hashed" in str(staged.inputFiles()) and sorted(plain.collect()) == sorted(staged.collect())


def test_best_tree_of_a_large_table_reads_values(rows, monkeypatch):
    """the grid is fitted on counts, and its best tree splits the features as they are."""
    monkeypatch.setattr(counted, "settle", lambda df, features, bins, least=0, settle=counted.settle: settle(df, features, bins, 0))
    wide = assemble(rows.drop("features"), ["a", "c"], "features")
    monkeypatch.setattr(counted, "ROWS_PER_GROUP", 1)
    values = {"maxDepth": [1, 4], "minInstancesPerNode": [1, 2000]}
    with monkeypatch.context() as m:
        m.setattr(models, "_validate", None)
        found = models.cross_validate(wide, models.decision_tree("y"), values, "y", ["id"])
    folded = models.with_folds(wide, ["id"], 3)
    model = counted.tune(folded, counted.settle(wide, "features", 32, 0), models.decision_tree("y"), values, "y", ["id"], 3, models.FOLD)
    assert scores(found.bestModel.transform(wide)) == pytest.approx(scores(model.transform(wide)), abs=1e-12)
    monkeypatch.setattr(counted, "suits", lambda estimator: False)
    plain = models.cross_validate(wide, models.decision_tree("y"), values, "y", ["id"])
    report = [sorted(models.parameter_report(wide.sparkSession, v.bestModel).collect()) for v in (found, plain)]
    assert report[0] == report[1] and found.avgMetrics == pytest.approx(plain.avgMetrics, rel=0.02)
    assert [r.best for r in models.cv_report(wide.sparkSession, found).collect()].count(True) == 1


def test_leaderboard_of_a_large_table_fits_lines_on_sums(rows, monkeypatch):
    """a linear model and its errors follow from the sums of the folds."""
    entries = {"line": (models.linear("y"), {**models.LINEAR_GRID, "regParam": [0.01, 2.0]}), "tree": (models.decision_tree("y"), {"maxDepth": [1, 4]})}
    train, test = rows.filter("id % 5 > 0"), rows.filter("id % 5 = 0")
    plain = {r["model"]: r for r in models.leaderboard(train, test, entries, "y", ["id"]).collect()}
    seen = []
    monkeypatch.setattr(counted, "LEAST_ROWS", 0)
    monkeypatch.setattr(counted, "least_rows", lambda estimator: 0)
    monkeypatch.setattr(fold_sums, "moment_rows", lambda *a, f=fold_sums.moment_rows: seen.append(f(*a)) or seen[-1])
    board = {r["model"]: r for r in models.leaderboard(train, test, entries, "y", ["id"]).collect()}
    assert len(seen) == 1 and seen[0].count() == 3 * 2 * 3
    for name in entries:
        assert board[name]["rmse"] == pytest.approx(plain[name]["rmse"], rel=1e-6) and board[name]["status"] == "ok"
        assert (board[name]["params"], board[name]["accuracy"]) == (plain[name]["params"], plain[name]["accuracy"])
