import pathlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.operators import models, pixels
from terrasift.plans import imagery
from terrasift.sources import images
from terrasift.streaming import incremental
from tests.conftest import png

SMALL = pixels.ImageOptions(short_edge=(12, 20), seed=3, feature_size=8)


def test_decode_and_broken_files(spark, image_tree):
    rows = {r["path"].split("/")[-1]: r for r in images.scan_images(spark, image_tree).collect()}
    assert set(rows) == {"a.png", "b.png", "c.png"}
    a = rows["a.png"]
    assert (a["height"], a["width"], a["channels"], a["mode"]) == (6, 8, 3, 16)
    assert bytes(a["data"][:3]) == bytes([100, 50, 0])
    kept = images.scan_images(spark, image_tree, keep_invalid=True).filter("height = -1").collect()
    assert [r["path"].split("/")[-1] for r in kept] == ["bad.jpg"]


def test_class_and_extension_scan(spark, image_tree):
    files = images.with_class(images.scan_files(spark, image_tree))
    got = sorted((r["path"].split("/")[-1], r["label"], r["label_id"]) for r in files.collect())
    assert got == [("a.png", "Cyclone", 0), ("b.png", "Flood", 2), ("bad.jpg", "Flood", 2), ("c.png", "Flood", 2)]
    assert images.scan_files(spark, image_tree, ["gif"]).count() == 0
    assert images.warn_if_empty(images.scan_files(spark, image_tree, ["gif"]), image_tree, ["gif"])
    assert not images.warn_if_empty(files, image_tree)
    assert images.scan_files(spark, image_tree, recursive=False).count() == 0
    with pytest.raises(FileNotFoundError):
        images.scan_files(spark, image_tree + "/absent")


def test_job_runs_every_step_and_repeats_itself(spark, image_tree):
    source = images.scan_images(spark, image_tree, keep_invalid=True)
    runs = [{r["path"]: r for r in pixels.preprocess(source.repartition(k), SMALL).collect()} for k in (1, 3)]
    assert len(runs[0]) == 4
    for path, row in runs[0].items():
        again = runs[1][path]
        assert (row["status"], row["data"], row["features"]) == (again["status"], again["data"], again["features"])
        if path.endswith("bad.jpg"):
            assert row["status"] == "error" and row["data"] is None and row["error"]
        else:
            assert 12 <= min(row["height"], row["width"]) <= 20
            assert len(row["data"]) == row["height"] * row["width"] * 3 and len(row["features"]) == 192
            assert -1 <= min(row["features"]) and max(row["features"]) <= 1


def test_only_new_images_are_processed(spark, image_tree, tmp_path):
    target = str(tmp_path / "out")
    first = imagery.preprocess_folder(spark, image_tree, target, SMALL)
    assert first.count() == 3
    second = imagery.preprocess_folder(spark, image_tree, target, SMALL, done=spark.read.parquet(target))
    assert second.count() == 3


def test_stream_takes_new_images_once(spark, image_tree, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    incremental.preprocess_new_images(spark, image_tree, target, checkpoint, SMALL)
    assert spark.read.parquet(target).count() == 3
    incremental.preprocess_new_images(spark, image_tree, target, checkpoint, SMALL)
    assert spark.read.parquet(target).count() == 3
    (pathlib.Path(image_tree) / "Flood" / "later.png").write_bytes(png(9, 9, lambda x, y: (x, y, 3)))
    incremental.preprocess_new_images(spark, image_tree, target, checkpoint, SMALL)
    rows = spark.read.parquet(target)
    assert rows.count() == 4 and rows.filter("status = 'ok'").count() == 4


def test_stream_cleans_new_tables(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.csv").write_text("a,b\n1,x\nbad,y\n")
    args = (str(source), str(tmp_path / "out"), str(tmp_path / "check"), "a string, b string", ["a"])
    incremental.clean_new_tables(spark, *args)
    (source / "2.csv").write_text("a,b\n2.5,z\n")
    incremental.clean_new_tables(spark, *args)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1.0, "x"), (2.5, "z")]


def test_split_and_report(spark, tmp_path):
    files = spark.createDataFrame([(f"r/{c}/{i}.png", c) for c in ("Flood", "Cyclone") for i in range(20)], "path string, label string")
    out = imagery.split_folder(files, str(tmp_path / "split"))
    assert (tmp_path / "split" / "split=train" / "label=Flood").is_dir()
    assert out.filter("split = 'train'").count() == 28
    scored = spark.createDataFrame([("r/Flood/1", "Flood", "Flood", 0.9, "ok"), ("r/Flood/2", "Flood", "Wildfire", 0.4, "ok")],
                                   "path string, true_label string, predicted string, confidence double, status string")
    report = imagery.report(scored)
    assert report["accuracy"].first()["accuracy_pct"] == 50.0
    assert report["confusion"].count() == 16 and report["wrong"].first()["path"] == "r/Flood/2"


def test_classifier_tells_bright_from_dark(spark):
    rows = [(f"r/{'Flood' if i % 2 else 'Cyclone'}/{i}.png", i % 2, 4, 4, 3,
             bytearray(((200 if i % 2 else 20) + (7 * i + k) % 30) for k in range(48))) for i in range(60)]
    table = spark.createDataFrame(rows, "path string, label_id int, height int, width int, channels int, data binary")
    model, scored = imagery.train_classifier(table, pixels.ImageOptions(steps=("blur",), feature_size=4), max_iter=20)
    assert scored.count() == 10 and scored.filter("prediction = label_id").count() == 10
    named = imagery.classify_images(scored.select("path").join(
        pixels.preprocess(table, pixels.ImageOptions(steps=("blur",), feature_size=4)), "path"), model, ["Cyclone", "Flood"])
    assert named.filter("true_label = predicted").count() == 10


def test_prediction_job_with_broken_files(spark, image_tree, tmp_path):
    rows = [(f"r/{'Flood' if i % 2 else 'Cyclone'}/{i}.png", i % 2, 4, 4, 3,
             bytearray(((200 if i % 2 else 20) + (7 * i + k) % 30) for k in range(48))) for i in range(40)]
    table = spark.createDataFrame(rows, "path string, label_id int, height int, width int, channels int, data binary")
    options = pixels.ImageOptions(steps=("blur",), feature_size=4)
    model, _ = imagery.train_classifier(table, options, max_iter=20)
    models.save_model(model, str(tmp_path / "model"))
    got, accuracy = imagery.predict_folder(spark, image_tree, str(tmp_path / "model"), str(tmp_path / "out"), options, ["Cyclone", "Flood"])
    by_name = {r["path"].rsplit("/", 1)[1]: r for r in got.collect()}
    assert {n: r["status"] for n, r in by_name.items()} == {"a.png": "ok", "b.png": "ok", "c.png": "ok", "bad.jpg": "error"}
    assert by_name["bad.jpg"]["predicted"] == "Error" and by_name["bad.jpg"]["confidence"] is None
    wrong = {n for n, r in by_name.items() if r["status"] == "ok" and r["true_label"] != r["predicted"]}
    assert {r[0].rsplit("/", 1)[1] for r in spark.read.text(str(tmp_path / "out/wrong_paths")).collect()} == wrong
    assert accuracy.first()["known"] == 3 and accuracy.first()["accuracy_pct"] == pytest.approx(100 * (3 - len(wrong)) / 3)
    written = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out/predictions"))
    assert written.count() == 4 and written.columns[0] == "图像路径"


def test_resize_weights():
    for size_in, size_out in ((8, 16), (16, 8), (7, 7), (5, 13)):
        assert np.allclose(pixels.triangle_weights(size_in, size_out).sum(axis=1), 1)
        low, high, share = pixels.bilinear_taps(size_in, size_out)
        assert low.min() >= 0 and high.max() < size_in and (0 <= share).all() and (share < 1).all()
    assert np.allclose(pixels.triangle_weights(4, 2)[0], [3 / 7, 3 / 7, 1 / 7, 0])
    noise = np.random.default_rng(0).integers(0, 256, (2, 9, 6, 3), dtype=np.uint8)
    assert pixels.resize(noise, 9, 6) is noise
    small = pixels.resize(noise, 3, 2, antialias=True)
    assert small.shape == (2, 3, 2, 3) and abs(small.mean() - noise.mean()) < 12
    ramp = np.arange(4, dtype=float).reshape(1, 1, 4, 1).repeat(3, axis=3).repeat(4, axis=1) * 40
    assert pixels.resize(ramp.astype(np.uint8), 4, 8)[0, 0, :, 0].tolist() == [0, 10, 30, 50, 70, 90, 110, 120]


def test_kernels_on_known_pictures():
    flat = np.full((1, 6, 6, 3), 90, np.uint8)
    assert (pixels.blur(flat) == 90).all() and (pixels.opening(flat) == 90).all()
    assert (pixels.equalize_luma(flat, (114, 587, 299)) == 90).all()
    assert (pixels.haar(flat) == 0).all() and (pixels.haar(flat, "smooth") == 90).all()
    spot = flat.copy()
    spot[0, 2, 2] = 255
    assert (pixels.opening(spot) == 90).all() and pixels.blur(spot)[0, 2, 2, 0] > 90
    two = np.zeros((1, 4, 4, 3), np.uint8)
    two[:, :, 2:] = 10
    assert set(np.unique(pixels.equalize_luma(two, (114, 587, 299)))) == {0, 255}
    assert pixels.haar(np.full((1, 5, 7, 3), 9, np.uint8)).shape == (1, 5, 7, 3)


def test_jitter_follows_the_colour_axis():
    grey = np.arange(48).reshape(4, 4, 3) // 3 * 10
    moved = pixels.jitter(grey, np.array([0.01, 0.0, 0.0])).astype(int) - grey
    assert np.ptp(moved.reshape(-1, 3), axis=1).max() <= 1 and abs(moved).max() > 0


def test_grey_and_alpha():
    assert pixels.decode(bytes(range(6)), 2, 3, 1).shape == (2, 3, 3)
    assert pixels.decode(bytes(24), 2, 3, 4).shape == (2, 3, 3)


def test_unknown_step_is_an_error_row(spark, image_tree):
    out = pixels.preprocess(images.scan_images(spark, image_tree), pixels.ImageOptions(steps=("sharpen",)))
    assert out.filter(F.col("status") == "error").count() == 3


def test_tasks_that_write_pictures_grow_with_them(spark, tmp_path, monkeypatch):
    from terrasift.plans.catalog import images as catalog
    spark.range(60).selectExpr("id AS vec_id", "0 AS label", "transform(sequence(1, 64), i -> float(i + id) / 200) AS embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    kind, asked = type(spark.range(1)), []
    inner = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *cols: asked.append(n) or inner(self, n, *cols))
    monkeypatch.setattr(catalog, "FILES_PER_TASK", 5)
    assert catalog.image_decode(spark, str(tmp_path)).groupBy().sum("pictures").first()[0] == 180
    assert 12 in asked
