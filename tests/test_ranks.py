import random

import numpy as np
from pyspark.sql import functions as F

from terrasift.operators import charts, ranks


def test_running_totals_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(g, float(v), rng.randint(1, 9)) for g in ("a", "b", None) for v in rng.sample(range(1000), 150)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    for ascending in (True, False):
        out = ranks.running_totals(df, "v", ["n"], ["g"], ascending, ranges=9).collect()
        assert len(out) == len(rows)
        for r in out:
            mine = [x for x in rows if x[0] == r["g"]]
            upto = [x[2] for x in mine if (x[1] <= r["v"] if ascending else x[1] >= r["v"])]
            assert (r["cum_n"], r["all_n"]) == (sum(upto), sum(x[2] for x in mine))


def test_quantiles_with_a_hot_value_and_a_hot_group(spark):
    rng = np.random.default_rng(2)
    hot = [("hot", 5.0)] * 900 + [("hot", float(v)) for v in rng.normal(5, 3, 600)]
    rows = hot + [("few", 1.0), ("few", 2.0), ("one", 7.5), ("few", None), ("few", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in ranks.exact_quantiles(df, "v", probs, ["g"], ranges=7).collect()}
    for g in ("hot", "few", "one"):
        values = [v for k, v in rows if k == g and v is not None and v == v]
        assert got[g]["n"] == len(values)
        assert np.allclose([got[g][f"q{i}"] for i in range(len(probs))], np.quantile(values, probs))


def test_roc_with_one_dominant_score(spark):
    rng = random.Random(4)
    rows = [(0.5, rng.randint(0, 1)) for _ in range(400)] + [(rng.random(), rng.randint(0, 1)) for _ in range(300)]
    points = charts.roc_points(spark.createDataFrame(rows, "s double, y int"), "s", "y", ranges=5)
    last = points.orderBy("s" if "s" in points.columns else "score").first()
    assert (last["tpr"], last["fpr"]) == (1.0, 1.0)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(charts.roc_auc(points).first()["auc"] - area) < 1e-12


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,), (float("nan"),)], "v double")
    rows = charts.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 2]
    assert (rows[0]["lower"], rows[4]["upper"]) == (0.0, 10.0)
    flat = charts.histogram(df.filter(F.col("v") == 1.0), "v", 3).orderBy("bin").collect()
    assert [r["n"] for r in flat] == [1, 0, 0]


def test_box_marks_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 1.0)], "g string, v double")
    rows = {r["g"]: r for r in charts.box_stats(df, "v", "g").collect()}
    assert (rows["a"]["median"], rows["a"]["whisker_high"], rows["a"]["outliers"]) == (3.0, 4.0, 1)
    assert rows["b"]["outliers"] == 0


def test_infinities_and_text_scores(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", v) for v in (-inf, 1.0, 2.0, 3.0, inf)] + [("b", inf)], "g string, v double")
    got = {r["g"]: r for r in ranks.exact_quantiles(df, "v", [0.5], ["g"], ranges=4).collect()}
    assert got["a"]["q0"] == 2.0 and got["b"]["max"] == inf
    text = spark.createDataFrame([(k, y) for k, y in zip("abcdef", (0, 0, 1, 0, 1, 1))], "s string, y int")
    points = charts.roc_points(text, "s", "y", ranges=3)
    assert [r["tp"] for r in points.orderBy(F.desc("score")).collect()] == [1, 2, 2, 3, 3, 3]
    bins = {r["bin"]: r for r in charts.histogram(df, "v", 2).collect()}
    assert {k: r["n"] for k, r in bins.items()} == {-1: 1, 0: 1, 1: 2, 2: 2} and (bins[0]["lower"], bins[1]["upper"]) == (1.0, 3.0)


def test_softmax_grows_with_the_scores(spark):
    import time
    from terrasift.functions.vectors import softmax

    def seconds(k):
        df = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda x: (x * F.col("id") % 7).cast("double")).alias("s"))
        start = time.perf_counter()
        total = df.select(F.aggregate(softmax(F.col("s")), F.lit(0.0), lambda a, x: a + x).alias("t")).agg(F.min("t"), F.max("t")).first()
        assert abs(total[0] - 1) < 1e-9 and abs(total[1] - 1) < 1e-9
        return time.perf_counter() - start
    seconds(400)
    assert seconds(6400) < 40 * max(seconds(400), 0.05)
