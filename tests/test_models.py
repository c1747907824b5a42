import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from terrasift.operators import charts, classify, features, models
from terrasift.plans import tabular
from terrasift.registry import CHINA_FEATURES, DatasetSpec

KEYS = ["id"]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    y = 3 * x[:, 0] - x[:, 1] + 1 + rng.normal(scale=0.3, size=400)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "id int, a double, b double, y double")
    return features.assemble(df, ["a", "b"], "features").cache()


def test_grid_values_reach_the_model(noisy, spark):
    fitted = models.cross_validate(noisy, models.linear("y"), {"regParam": [0.0, 50.0], "elasticNetParam": [0.0, 0.5]}, "y", KEYS)
    report = {r["params"]: r for r in models.cv_report(spark, fitted).collect()}
    assert len(report) == 4
    assert report["elasticNetParam=0.0, regParam=50.0"]["rmse"] > 2 * report["elasticNetParam=0.0, regParam=0.0"]["rmse"]
    assert math.isclose(report["elasticNetParam=0.0, regParam=0.0"]["rmse"], report["elasticNetParam=0.5, regParam=0.0"]["rmse"], rel_tol=1e-6)
    assert [r["best"] for r in report.values()].count(True) == 1
    assert fitted.bestModel.getRegParam() == 0.0
    params = {r["param"]: r["value"] for r in models.parameter_report(spark, fitted.bestModel).collect()}
    assert params["regParam"] == "0.0"


def test_tree_and_forest_grids(noisy):
    for estimator, values in ((models.decision_tree("y"), {"maxDepth": [1, 5]}), (models.random_forest("y"), {"numTrees": [1, 5]})):
        scores = models.cross_validate(noisy, estimator, values, "y", KEYS).avgMetrics
        assert scores[0] != scores[1]


def test_cross_validation_ignores_partitioning(noisy):
    scores = [models.cross_validate(noisy.repartition(k), models.linear("y", solver="normal"), {"regParam": [0.1, 1.0]}, "y", KEYS).avgMetrics for k in (2, 9)]
    assert np.allclose(*scores)


def test_candidates_hold_the_published_settings():
    entries = models.candidates("y")
    assert [len(models.grid(e, v)) for e, v in entries.values()] == [4, 4, 4, 0]
    boost = entries["GBT Regression"][0]
    assert (boost.getMaxIter(), boost.getMaxDepth(), boost.getSeed()) == (50, 10, 42)


def test_leaderboard_survives_a_bad_model(noisy, spark):
    train, test = noisy.filter("id % 5 > 0"), noisy.filter("id % 5 = 0")
    entries = {"linear": (models.linear("y"), {"regParam": [0.0, 0.1]}), "tree": (models.decision_tree("y"), {}),
               "broken": (models.boosted_trees("y", maxBins=2, maxIter=1, maxDepth=31), {})}
    board = {r["model"]: r for r in models.leaderboard(train, test, entries, "y", KEYS).collect()}
    spread = test.agg(F.stddev_pop("y")).first()[0]
    assert board["linear"]["rmse"] < 0.4 < board["tree"]["rmse"] < spread and board["linear"]["accuracy"] > 0.8
    assert math.isinf(board["broken"]["rmse"]) and board["broken"]["accuracy"] == 0.0 and board["broken"]["status"].startswith("failed")


def test_save_load(noisy, spark, tmp_path):
    model = models.fit_features(noisy.drop("features"), ["a", "b"], pca_k=2)
    models.save_model(model, str(tmp_path / "m"))
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"), PipelineModel)
    frame = noisy.drop("features").orderBy("id").limit(5)
    assert [r["features"] for r in again.transform(frame).collect()] == [r["features"] for r in model.transform(frame).collect()]
    with pytest.raises(FileNotFoundError, match="no model"):
        models.load_model(str(tmp_path / "none"))


def test_tree_reports(noisy, spark):
    tree = models.fit(models.decision_tree("y", maxDepth=2), noisy)
    rules = charts.tree_rules(spark, tree, ["a", "b"]).orderBy("line").collect()
    assert (rules[0]["kind"], rules[0]["depth"], rules[0]["feature"]) == ("if", 0, "a")
    leaves = [r["prediction"] for r in rules if r["kind"] == "leaf"]
    assert len(leaves) == 4 and all(v is not None for v in leaves)
    assert sum(r["kind"] == "if" for r in rules) == sum(r["kind"] == "else" for r in rules) == 3
    weights = {r["feature"]: r["importance"] for r in charts.feature_importance(spark, tree, ["a", "b"]).collect()}
    assert weights["a"] > weights["b"] and math.isclose(sum(weights.values()), 1)
    scored = tree.transform(noisy)
    assert abs(charts.residuals(scored, "y").agg(F.avg("residual")).first()[0]) < 1e-9
    assert charts.predicted_vs_actual(scored, "y", keep=["id"]).columns == ["id", "actual", "predicted"]


def _catalogue(tmp_path, encoding="gbk", sep=";", rows=120):
    rng = np.random.default_rng(11)
    head = ["序号", "发震时刻(国际时)", "经度(°)", "纬度(°)", "震源深度（Km）", "Ms", "Ms7", "mL", "mb", "mB", "地点"]
    lines = [sep.join(head)]
    for i in range(rows):
        m = rng.uniform(3, 7)
        depth = "N/A" if i % 10 == 0 else f"{rng.uniform(5, 60):.1f}"
        lines.append(sep.join([str(i), "2020-01-01 00:00:00", "100.1", "30.2", depth, f"{m:.1f}", f"{m + .1:.1f}",
                               f"{m - .2:.1f}", f"{m + .05:.2f}", f"{m - .05:.2f}", "四川"]))
    target = tmp_path / "catalogue.csv"
    target.write_bytes("\n".join(lines).encode(encoding))
    return str(target)


def test_named_dataset_from_a_dirty_file(spark, tmp_path):
    path = _catalogue(tmp_path)
    scored, rmse = tabular.train_dataset(spark, "中国地震台网地震目录数据集训练", path, ["序号"], str(tmp_path / "out"), trees=10)
    assert scored.count() == 108 and rmse.first()["rmse"] < 1.0
    assert scored.filter("split = 'test'").count() == 22
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["Ms7", "预测值"] and back.count() == 108
    whole, _ = tabular.train_dataset(spark, "CEN_Center_Earthquake_Catalog", path, trees=2)
    assert whole.count() == 108 and whole.filter("split = 'test'").count() == 22
    with pytest.raises(ValueError, match="unknown dataset"):
        tabular.train_dataset(spark, "nope", path, ["序号"])


def test_feature_job_and_comparison(spark, tmp_path):
    from terrasift.registry import dataset
    from terrasift.sources import headers, sniff, tables
    df = headers.clean_headers(sniff.read_delimited(spark, _catalogue(tmp_path)))
    spec = dataset("CEN_Center_Earthquake_Catalog")
    table = tabular.build_features(df, spec, str(tmp_path), single_file=True)
    assert "normalized_mb8" in table.columns and "normalized_Ms7" not in table.columns and table.count() == 108
    back = tables.read_csv(spark, str(tmp_path / "processed_CEN_Center_Earthquake_Catalog_normalized_MinMaxScaler"))
    assert back.count() == 108
    entries = {"linear": (models.linear("Ms7"), models.LINEAR_GRID)}
    board = tabular.compare_models(df, spec, ["序号"], entries).collect()
    assert board[0]["status"] == "ok" and board[0]["rmse"] < 1.5
    with pytest.raises(ValueError, match="usable rows"):
        tabular.build_features(df.withColumn("mL", F.lit("x")), spec)
    assert CHINA_FEATURES == spec.features


def test_clean_file(spark, tmp_path):
    source = tmp_path / "losses.csv"
    source.write_text("time,deaths,loss\n2020,1,10\n2021,,20\n")
    row = tabular.clean_file(spark, str(source), str(tmp_path / "clean")).first()
    assert (row["rows_before"], row["rows_after"]) == (2, 1)
    assert spark.read.option("header", True).csv(str(tmp_path / "clean")).count() == 1


def test_train_needs_rows_and_columns(spark, noisy):
    spec = DatasetSpec("t", ["a"], "y")
    with pytest.raises(ValueError, match="needs 2"):
        models.train_and_score_all(noisy.limit(1).drop("features"), spec, KEYS)
    with pytest.raises(ValueError, match="missing columns"):
        models.train_and_score_all(noisy, DatasetSpec("t", ["zz"], "y"), KEYS)


def test_classifiers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(loc=3 * (i % 3), size=4)], i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, f array<double>, y int")
    for kind, layers in (("logistic", None), ("perceptron", [4, 8, 3])):
        out = classify.classify(df, classify.fit_classifier(df, "f", "y", kind, layers), "f", keep=["id", "y"])
        assert out.filter("prediction = y").count() > 130
        row = out.first()
        assert math.isclose(sum(row["probabilities"]), 1.0, rel_tol=1e-6) and row["confidence"] == max(row["probabilities"])
    with pytest.raises(ValueError):
        classify.fit_classifier(df, "f", "y", "forest")


def test_batch_scores_capture_failures(spark):
    def make():
        def predict(batch):
            if (batch[:, 0] < 0).any():
                raise RuntimeError("negative")
            return np.stack([batch[:, 0], batch.sum(axis=1)], axis=1)
        return predict
    rows = [(i, [float(i), 1.0]) for i in range(100)] + [(100, [-1.0, 0.0]), (101, None), (102, [1.0]), (103, [1.0, None])]
    df = spark.createDataFrame(rows, "id int, f array<double>").repartition(3)
    out = {r["id"]: r for r in classify.batch_scores(df, "f", 2, make, batch_size=16).collect()}
    assert len(out) == 104
    assert all(out[i]["scores"] == [float(i), i + 1.0] and out[i]["status"] == "ok" for i in range(100))
    assert [(out[i]["status"], out[i]["error"]) for i in (100, 101, 102, 103)] == [
        ("error", "model failed")] + [("error", "unusable features")] * 3
