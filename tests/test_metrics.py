import math

import pytest
from pyspark.sql import functions as F

from terrasift.functions import labels, vectors
from terrasift.operators import classify, metrics
from terrasift.registry import IMAGE_CLASSES

# Tally of 669 published predictions, rows = true class.
GOLDEN = [[121, 5, 0, 14], [3, 179, 12, 10], [5, 17, 130, 10], [2, 5, 5, 151]]


@pytest.fixture(scope="module")
def golden(spark):
    cells = [(IMAGE_CLASSES[i], IMAGE_CLASSES[j], n) for i, row in enumerate(GOLDEN) for j, n in enumerate(row)]
    return (spark.createDataFrame(cells, "t string, p string, n int")
            .select("t", "p", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n"))))).select("t", "p"))


def test_golden_confusion(golden):
    got = metrics.accuracy(golden, "t", "p").first()
    assert (got["correct"], got["total"], round(got["accuracy"], 6)) == (581, 669, 0.868460)
    cells = {(r["y"], r["x"]): r["n"] for r in metrics.heatmap_triples(golden, "t", "p").collect()}
    assert cells == {(i, j): n for i, row in enumerate(GOLDEN) for j, n in enumerate(row)}
    assert metrics.misclassified(golden, "t", "p").count() == 88
    assert metrics.colour_maximum(golden, "t", "p").first()[0] == 179


def test_absent_label_fills_with_zero(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B")], "t string, p string")
    cells = {(r["true_label"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "t", "p", ["A", "B", "C"]).collect()}
    assert len(cells) == 9 and cells[("A", "A")] == cells[("A", "B")] == 1 and sum(cells.values()) == 2
    empty = df.limit(0)
    assert metrics.colour_maximum(empty, "t", "p").first()[0] == 1
    assert metrics.confusion_matrix(empty, "t", "p").count() == 16
    with pytest.raises(ValueError):
        metrics.confusion_counts(df, "t", "absent")


def test_any_number_of_labels(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("t"), F.lit("x").alias("p"))
    assert metrics.label_universe(df, "t", "p", []).count() == 3001
    cells = metrics.heatmap_cells(df, "t", "p", []).collect()
    order = sorted([*map(str, range(3000)), "x"])
    assert {(r["y"], r["x"]) for r in cells} == {(order.index(str(k)), order.index("x")) for k in range(3000)}


def test_square_pivot(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "b"), (None, "b")], "t string, p string")
    square = metrics.confusion_pivot(df, "t", "p", ["z"])
    assert square.columns == ["true_label", "a", "b", "c", "z"]
    assert {tuple(r) for r in square.collect()} == {("a", 0, 1, 1, 0), ("b", 0, 1, 0, 0), ("c", 0, 0, 0, 0), ("z", 0, 0, 0, 0)}


def test_within_threshold(spark):
    df = spark.createDataFrame([(-0.5, 0.0), (0.5, 0.0), (0.51, 0.0), (None, 0.0)], "y double, p double")
    row = metrics.within_threshold(df, "y", "p").first()
    assert (row["correct"], row["total"]) == (2, 3) and row["accuracy"] == pytest.approx(2 / 3)
    none = df.filter("y is null")
    assert metrics.within_threshold(none, "y", "p").first()["accuracy"] == 0.0
    assert metrics.rmse(df.limit(2), "y", "p").first()["rmse"] == 0.5


def test_accuracy_known(spark):
    df = spark.createDataFrame([("Flood", "Flood", "ok"), ("Flood", "Cyclone", "ok"), ("Unknown", "Flood", "ok"),
                                ("Flood", "Flood", "error")], "t string, p string, status string")
    row = metrics.accuracy_known(df, "t", "p", "status").first()
    assert (row["accuracy_pct"], row["known"]) == (50.0, 2)
    assert metrics.accuracy_known(df.filter("t = 'Unknown'"), "t", "p").first()["accuracy_pct"] is None


def test_top_class(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [1000.0, 0.0, 0.0, 0.0]), (3, None)], "id int, s array<double>")
    rows = {r["id"]: r for r in classify.top_class(df, "s", keep=["id"]).collect()}
    assert (rows[1]["class_id"], rows[1]["predicted"], round(rows[1]["confidence"], 4)) == (3, "Wildfire", 0.6439)
    assert rows[2]["confidence"] == 1.0 and rows[3]["predicted"] is None
    assert spark.range(1).select(vectors.softmax(F.array(F.lit(0.0), F.lit(0.0))).alias("p")).first()["p"] == [0.5, 0.5]


def test_names_and_labels(spark):
    one = spark.createDataFrame([(7, "x/Cyclone_Flood_db/Flood/0.jpg"), (2, "a/b.c/label=Wildfire/x.y.png")], "i int, p string")
    rows = one.select(labels.class_name(F.col("i")).alias("n"), labels.label_from_path(F.col("p")).alias("dir"),
                      labels.label_from_path(F.col("p"), mode="substring").alias("sub"),
                      labels.file_stem(F.col("p")).alias("stem")).collect()
    assert tuple(rows[0]) == ("未知(7)", "Flood", "Cyclone", "0")
    assert tuple(rows[1]) == ("Flood", "Wildfire", "Wildfire", "x.y")
    with pytest.raises(ValueError):
        labels.label_from_path(F.col("p"), mode="guess")


def test_misclassified_by_path_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, "x", "y"), ("a", 1, "x", "z"), ("b", 1, "x", "x")], "path string, epoch int, t string, p string")
    rows = metrics.misclassified(df, "t", "p", "path").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "x", "z")]


def test_losses(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5], 0), (1, [0.5, 0.5], 0), (1, [0.75, 0.25], 1)], "y int, p array<double>, b int")
    assert metrics.log_loss(df, "y", "p").first()[0] == pytest.approx((2 * math.log(2) + math.log(4)) / 3)
    assert metrics.batch_mean_loss(df, "y", "p", "b").first()[0] == pytest.approx((math.log(2) + math.log(4)) / 2)
