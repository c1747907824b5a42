import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from terrasift.functions.vectors import vector_to_array
from terrasift.operators import features

NAN = float("nan")


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(0, 1.0, 5.0, 0.0), (1, 2.0, 5.0, 0.0), (2, 3.0, 5.0, 0.0), (3, NAN, 5.0, None)],
                                 "id int, a double, b double, c double").coalesce(1)


def _close(got, want):
    return all((g is None and w is None) or (g is not None and w is not None and (math.isnan(g) and math.isnan(w) or abs(g - w) < 5e-5))
               for g, w in zip(got, want))


SCALED = [(0, .5, .5), (.5, .5, .5), (1, .5, .5), (NAN, .5, NAN)]
NORMAL = [(0, .7071, .7071), (.5774, .5774, .5774), (.8165, .4082, .4082), (NAN, NAN, NAN)]


def test_mllib_keep_scale_normalize(small):
    out = Pipeline(stages=features.feature_stages(["a", "b", "c"], invalid="keep")).fit(small).transform(small)
    rows = out.orderBy("id").select(vector_to_array("scaled"), vector_to_array("features")).collect()
    assert all(_close(r[0], w) for r, w in zip(rows, SCALED))
    assert all(_close(r[1], w) for r, w in zip(rows, NORMAL))


def test_expressions_equal_mllib(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(200)] + [(200, 0.0, 0.0, 0.0)],
                               "id int, a double, b double, c double").withColumn("k", F.lit(4.0))
    cols = ["a", "b", "c", "k"]
    model = Pipeline(stages=features.feature_stages(cols)).fit(df)
    ml = {r["id"]: r["v"] for r in model.transform(df).select("id", vector_to_array("features").alias("v")).collect()}
    mine = features.feature_table(df, cols, keep=["id"]).collect()
    assert len(mine) == 201
    for r in mine:
        values = [r[f"normalized_{c}"] for c in cols]
        assert np.allclose(values, ml[r["id"]])
        assert math.isclose(sum(v * v for v in values), 1.0, abs_tol=1e-9)
        assert all(0 <= r[f"MinMaxScaler_{c}"] <= 1 for c in cols)


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "a double, b double")
    rows = features.feature_table(df, ["a", "b"]).orderBy("a").collect()
    assert (rows[0]["normalized_a"], rows[0]["normalized_b"]) == (0.0, 0.0)


def test_skip_and_accounting(small):
    assert features.assemble(small, ["a", "b", "c"], "v", "skip").count() == 3
    assert features.skip_accounting(small, ["a", "b", "c"]).first().asDict() == {"rows_kept": 3, "rows_skipped": 1}
    with pytest.raises(ValueError):
        features.assemble(small, ["a", "nope"])


def test_clamp():
    assert [features.clamp_k(k, 4) for k in (0, -1, 2, 4, 9, None)] == [4, 4, 2, 4, 4, 4]
    assert features.clamp_k(3, 0) == 0
    assert features.fit_pca(None, [], 3) is None


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    ratios = [r["ratio"] for r in features.explained_variance(df, cols, 9).orderBy("component").collect()]
    values, vectors = np.linalg.eigh(np.cov(data.T))
    assert np.allclose(ratios, values[::-1] / values.sum())
    got = np.array([list(r)[4:] for r in features.pca_project(df, cols, 2).collect()])
    want = data @ vectors[:, ::-1][:, :2]
    assert np.allclose(np.sort(np.abs(got), axis=0), np.sort(np.abs(want), axis=0))


def test_new_data_uses_fitted_ranges(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    ranges = features.fit_ranges(train, ["a"])
    out = features.scaled_table(spark.createDataFrame([(5.0,)], "a double"), ["a"], ranges=ranges, normalize=False)
    assert out.first()["MinMaxScaler_a"] == 0.5
