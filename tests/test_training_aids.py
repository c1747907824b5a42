import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.operators import bagging, boosting, fold_sums, models, work
from terrasift.operators.features import assemble


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 3)) * [1.0, 50.0, 0.01] + [5.0, -3.0, 100.0]
    y = x @ [0.7, 0.02, 30.0] + rng.normal(size=900) * 0.5
    data = [(k, *map(float, r), 7.0, float(v)) for k, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, flat double, y double").repartition(5)


COLUMNS = ["a", "b", "c"]


def test_one_pass_grid_equals_cross_validation(spark, rows):
    grid = {"regParam": [0.01, 0.3], "elasticNetParam": [0.0, 0.5]}
    fitted = models.cross_validate(assemble(rows, COLUMNS, "features"), models.linear("y"), grid, "y", ["id"])
    want = models.cv_report(spark, fitted).orderBy("cell").collect()
    got = fold_sums.linear_grid(rows, COLUMNS, "y", ["id"], grid).orderBy("cell").collect()
    assert [(r.params, r.best) for r in got] == [(r.params, r.best) for r in want]
    assert [r.rmse for r in got] == pytest.approx([r.rmse for r in want], rel=1e-4)


def test_grid_reads_the_table_once(rows, monkeypatch):
    seen = []
    monkeypatch.setattr(fold_sums, "fold_moments", lambda df, *args, inner=fold_sums.fold_moments: seen.append(df) or inner(df, *args))
    fold_sums.linear_grid(rows, COLUMNS, "y", ["id"])
    assert len(seen) == 1


def test_constant_column_and_label(rows):
    got = fold_sums.linear_grid(rows, [*COLUMNS, "flat"], "y", ["id"], {"regParam": [0.1], "elasticNetParam": [0.0, 0.5]}).collect()
    without = fold_sums.linear_grid(rows, COLUMNS, "y", ["id"], {"regParam": [0.1], "elasticNetParam": [0.0, 0.5]}).collect()
    assert [r.rmse for r in got] == pytest.approx([r.rmse for r in without])
    assert fold_sums.linear_grid(rows, COLUMNS, "flat", ["id"]).agg(F.max("rmse")).first()[0] == pytest.approx(0.0, abs=1e-9)


def test_merged_folds_are_the_whole(rows):
    found = fold_sums.fold_moments(models.with_folds(rows, ["id"], 4), COLUMNS, "y")
    n, means, products = fold_sums.merged(found.values())
    table = np.array([tuple(r) for r in rows.select(*COLUMNS, "y").collect()])
    assert n == 900 and means == pytest.approx(table.mean(axis=0))
    assert products == pytest.approx(np.cov(table.T, bias=True) * 900, rel=1e-9)
    beta, intercept = fold_sums.solve((n, means, products))
    error = ((table[:, 3] - table[:, :3] @ beta - intercept) ** 2).mean()
    assert fold_sums.squared_error((n, means, products), beta, intercept) == pytest.approx(error)


def test_too_few_folds(rows):
    with pytest.raises(ValueError, match="two are needed"):
        fold_sums.linear_grid(rows.limit(1), COLUMNS, "y", ["id"])


def test_poisson_copies(spark):
    draws = spark.range(200_000).select(bagging.tree_weight(["id"], 3).alias("w"))
    counts = {r.w: r["count"] / 200_000 for r in draws.groupBy("w").count().collect()}
    for k in range(4):
        assert counts[float(k)] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.005)


def test_forest_does_not_depend_on_the_partitions(spark, rows, tmp_path):
    def fitted(df):
        return bagging.fit_hashed_forest(df, COLUMNS, "y", ["id"], trees=4, bins=16, maxDepth=4)
    first = fitted(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        second = fitted(rows.orderBy(F.desc("b")).repartition(2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    scores = [{r.id: round(r.prediction, 9) for r in forest.transform(rows).collect()} for forest in (first, second)]
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 20
    error = np.mean([(r.y - scores[0][r.id]) ** 2 for r in rows.collect()])
    assert error < 0.5 * rows.agg(F.var_pop("y")).first()[0]
    first.save(str(tmp_path / "forest"))
    again = bagging.HashedForest.load(str(tmp_path / "forest"))
    assert {r.id: round(r.prediction, 9) for r in again.transform(rows).collect()} == scores[0]


def test_stop_round_is_that_of_the_library(rows):
    df = assemble(rows, COLUMNS, "features")
    for tol, most in ((0.01, 25), (0.05, 24)):
        model = boosting.fit_until(df, "y", ["id"], tol=tol, maxIter=25, maxDepth=2)
        marked = boosting.mark_validation(df, ["id"])
        train, validation = marked.filter("NOT _validates"), marked.filter("_validates")
        whole = models.fit(models.boosted_trees("y", maxIter=25, maxDepth=2), train)
        table = boosting.loss_table(whole, train, validation, tol).orderBy("round").collect()
        assert len(table) == 25 and sum(r.kept for r in table) == model.getNumTrees <= most
        assert [r.train_loss for r in table] == sorted((r.train_loss for r in table), reverse=True)


def test_stop_rule():
    assert boosting.stop_round([1.0]) == 1
    assert boosting.stop_round([1.0, 0.5, 0.4, 0.3999, 0.1]) == 3
    assert boosting.stop_round([1.0, 1.2, 0.1]) == 1


def test_objective_and_class_losses(spark, rows):
    model = models.linear("y", solver="l-bfgs", maxIter=5).fit(assemble(rows, COLUMNS, "features"))
    values = [r.objective for r in boosting.objective_history(model).orderBy("iteration").collect()]
    assert values == sorted(values, reverse=True) and values[0] == pytest.approx(0.5, abs=0.01)
    scored = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.25, 0.75]), (1, [1.0, 0.0])], "k int, p array<double>")
    got = {r.label: (r.rows, r.loss) for r in boosting.losses_by_class(scored, "k", "p").collect()}
    assert got[0] == (1, pytest.approx(math.log(2))) and got[1][0] == 2 and got[1][1] > 17


class Lost(RuntimeError):
    pass


def test_comparison_resumes_where_it_was_lost(spark, rows, tmp_path, monkeypatch):
    df, folder = assemble(rows, COLUMNS, "features"), str(tmp_path / "work")
    entries = {"ridge": (models.linear("y"), {"regParam": [0.1, 10.0]}), "tree": (models.decision_tree("y", maxDepth=2), {})}
    written, inner = [], work.record

    def failing(spark, folder, row):
        if len(written) == 3:
            raise Lost
        written.append(row[:4])
        inner(spark, folder, row)
    monkeypatch.setattr(work, "record", failing)
    with pytest.raises(Lost):
        work.compare(df, df, entries, "y", ["id"], folder, parallelism=1)
    monkeypatch.setattr(work, "record", inner)
    board, ran = work.compare(df, df, entries, "y", ["id"], folder)
    assert len(ran) == 6 - 3 + 2 and not {tuple(k) for k in ran} & set(written)
    rows_first = sorted(map(tuple, board.collect()))
    again, ran = work.compare(df, df, entries, "y", ["id"], folder)
    assert ran == [] and sorted(map(tuple, again.collect())) == rows_first
    assert {r[0]: r[3] for r in rows_first} == {"ridge": "regParam=0.1", "tree": ""}
    more = {"ridge": (models.linear("y"), {"regParam": [0.1, 10.0, 0.001]}), "tree": entries["tree"]}
    assert len(work.compare(df, df, more, "y", ["id"], folder)[1]) == 3 + 1


def test_failing_model_leaves_a_row_and_is_tried_again(spark, rows, tmp_path):
    df, folder = assemble(rows, COLUMNS, "features"), str(tmp_path / "work")
    bad = {"bad": (models.linear("y", features="absent"), {})}
    for _ in range(2):
        board, ran = work.compare(df, df, bad, "y", ["id"], folder)
        assert len(ran) == 1 and board.count() == 1 and board.first()["status"].startswith("failed") and board.first()["rmse"] == math.inf
