import pytest
from pyspark.sql import functions as F

from terrasift import registry
from terrasift.operators import quality
from terrasift.sources import headers, sinks, sniff, tables


def _file(tmp_path, name, text, encoding="utf-8"):
    target = tmp_path / name
    target.write_bytes(text.encode(encoding))
    return str(target)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sep", [",", ";", "\t", "  "])
def test_separators(spark, tmp_path, sep):
    path = _file(tmp_path, "n.csv", "\n".join(sep.join(r) for r in (["id", "name", "v"], ["1", "x", "2.5"], ["2", "y", "3"])))
    df = sniff.read_delimited(spark, path)
    assert df.columns == ["id", "name", "v"] and _rows(df) == [(1, "x", 2.5), (2, "y", 3.0)]


def test_quoted_separators_do_not_count(spark, tmp_path):
    path = _file(tmp_path, "q.csv", 'a;b\n"1,2,3";x\n"4,5,6";y\n')
    assert sniff.sniff(spark, path).separator == ";"
    assert _rows(sniff.read_delimited(spark, path)) == [("1,2,3", "x"), ("4,5,6", "y")]


@pytest.mark.parametrize("encoding,expected", [("utf-8", "utf-8"), ("utf-8-sig", "utf-8"), ("gbk", "gbk")])
def test_encodings(spark, tmp_path, encoding, expected):
    body = "震级,地点\n" + "1.5,plain\n" * 50 + "6.1,四川\n"
    path = _file(tmp_path, "e.csv", body, encoding)
    assert sniff.sniff(spark, path).encoding == expected
    df = sniff.read_delimited(spark, path)
    assert df.columns == ["震级", "地点"] and df.filter(F.col("地点") == "四川").count() == 1


def test_latin1_is_the_last_resort(spark, tmp_path):
    path = _file(tmp_path, "l.csv", "a,b\n1,café\n2,é\n", "latin1")
    assert sniff.sniff(spark, path).encoding == "latin1"
    assert _rows(sniff.read_delimited(spark, path)) == [(1, "café"), (2, "é")]


def test_skipped_lines_and_given_names(spark, tmp_path):
    path = _file(tmp_path, "s.csv", "# made by hand\n# 2020\nid,v\n1,2.5\n2,\n")
    df = sniff.read_delimited(spark, path, skiprows=2)
    assert df.columns == ["id", "v"] and sorted((r["id"], r["v"]) for r in df.collect() if r["v"]) == [(1, 2.5)]
    assert df.count() == 2
    named = sniff.read_delimited(spark, path, skiprows=3, names=["k", "w"])
    assert named.columns == ["k", "w"] and named.count() == 2
    plain = sniff.read_delimited(spark, _file(tmp_path, "p.csv", "1,2\n3,4\n"), names=["k", "w"])
    assert _rows(plain) == [(1, 2), (3, 4)]


def test_missing_and_empty_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such path"):
        sniff.read_delimited(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="no data"):
        sniff.read_delimited(spark, _file(tmp_path, "empty.csv", ""))
    with pytest.raises(FileNotFoundError, match="catalogue: no such path"):
        tables.read_csv(spark, str(tmp_path / "none"), name="catalogue")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"), "t")


def test_header_rules(spark, tmp_path):
    assert headers.clean_name(" 深度（Km） ") == "深度(Km)"
    raw = ["序号", "发震时刻(国际时)", "经度(°)", "纬度(°)", "震源深度(Km)", "Ms", "Ms7", "mL", "mb", "mB", "地点"]
    safe = headers.safe_names(raw)
    assert safe[8:10] == ["mb8", "mB9"]
    path = _file(tmp_path, "h.csv", ",".join(raw) + "\n" + ",".join(["1"] * 11) + "\n")
    assert tables.read_csv(spark, path).columns == safe
    assert headers.resolve_columns(["mb", "Ms7", "absent"], safe) == ["mb8", "Ms7", "absent"]
    assert headers.resolve_columns(["mb"], ["mB", "mb"]) == ["mb"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert not sinks.write_csv(None, str(tmp_path / "x"))
    assert sinks.write_csv(df, str(tmp_path / "x")) and sinks.write_csv(df, str(tmp_path / "x"))
    assert _rows(tables.read_csv(spark, str(tmp_path / "x"), df.schema).na.fill("-")) == [(1, "a"), (2, "-")]
    sinks.write_single_csv(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1


def test_prediction_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r/Flood/1.jpg", 2, 2), ("r/Flood/2.jpg", 2, 0), ("r/Flood/3.jpg", 2, 9)],
                               "path string, label_id int, prediction int")
    sinks.write_predictions_tsv(df, str(tmp_path / "tsv"))
    lines = spark.read.text(str(tmp_path / "tsv")).distinct()
    assert {r[0] for r in lines.collect()} == {
        "图像路径\t真实值\t预测值", "r/Flood/1.jpg\tFlood\tFlood", "r/Flood/2.jpg\tFlood\tCyclone", "r/Flood/3.jpg\tFlood\t未知(9)"}
    assert sinks.write_error_paths(df, str(tmp_path / "err"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "err")).collect()} == {"r/Flood/2.jpg", "r/Flood/3.jpg"}
    assert not sinks.write_error_paths(df.limit(1), str(tmp_path / "err"))  # and nothing of the last run stays
    assert spark.read.text(str(tmp_path / "err")).count() == 0


def test_batch_prediction_files(spark, tmp_path):
    df = spark.createDataFrame([("p1", "Flood", "Flood", 0.9, "ok"), ("p2", "Flood", "Cyclone", 0.5, "ok"),
                                ("p3", "N/A", "Error", None, "error")],
                               "path string, true_label string, predicted string, confidence double, status string")
    assert sinks.write_batch_predictions(df, str(tmp_path / "a"), str(tmp_path / "w"))
    assert tables.read_csv(spark, str(tmp_path / "a")).count() == 3
    wrong = tables.read_csv(spark, str(tmp_path / "w"))
    assert wrong.columns == ["图像路径", "真实标签(推断)", "预测值", "置信度", "status"] and wrong.first()[0] == "p2"
    assert not sinks.write_batch_predictions(df.filter("path = 'p1'"), str(tmp_path / "b"), str(tmp_path / "w"))
    assert spark.read.schema(wrong.schema).csv(str(tmp_path / "w"), header=True).count() == 0


def test_quarantine_and_pending(spark, tmp_path):
    wrong = spark.createDataFrame([("r/Flood/1.jpg", 2), ("r/Flood/1.jpg", 1), ("r/Cyclone/2.jpg", 1)], "path string, epoch int")
    kept = spark.createDataFrame([("r/Flood/1.jpg",)], "path string")
    assert _rows(sinks.quarantine(wrong)) == [("r/Cyclone/2.jpg", 1, "Cyclone"), ("r/Flood/1.jpg", 1, "Flood")]
    assert _rows(sinks.quarantine(wrong, existing=kept)) == [("r/Flood/1.jpg", 1, "Flood")]
    sinks.write_partitioned(sinks.quarantine(wrong), str(tmp_path / "q"), "label")
    assert (tmp_path / "q" / "label=Flood").is_dir()
    left = sinks.pending(wrong, kept, "path")
    assert _rows(left) == [("r/Cyclone/2.jpg", 1)]


def test_ingest_keeps_going(spark, tmp_path):
    good = _file(tmp_path, "g.csv", "a,b\n1,2\n3,\n")
    status = {r["dataset"]: r for r in tables.ingest_all(
        spark, {"good": lambda: tables.read_csv(spark, good), "bad": lambda: tables.read_csv(spark, good + "x")},
        quality.row_accounting).collect()}
    assert (status["good"]["rows_before"], status["good"]["rows_dropped"], status["good"]["status"]) == (2, 1, "ok")
    assert status["bad"]["status"] == "failed"


def test_registry():
    spec = registry.dataset("中国地震台网地震目录数据集训练")
    assert spec.name == "CEN_Center_Earthquake_Catalog" and spec.label not in spec.features
    assert spec.label in spec.with_label().features
    with pytest.raises(ValueError, match="choose one of: .*GSN_Earthquake_Catalog"):
        registry.dataset("nope")
    assert len(registry.dataset_names()) == 4
    assert len(registry.dataset("Strong_Motion_Parameters_Dataset").features) == 12


def test_leading_lines_of_every_part_file(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"part-{k}.txt").write_text("note\nk  w\n" + "".join(f"{10 * k + i}  {i}.5\n" for i in range(30)))
    df = sniff.read_delimited(spark, str(tmp_path), skiprows=1)
    assert df.columns == ["k", "w"]
    assert sorted(_rows(df)) == sorted((10 * k + i, i + 0.5) for k in range(5) for i in range(30))
