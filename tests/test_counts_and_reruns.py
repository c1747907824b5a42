import os

import pytest
from pyspark.sql import functions as F

from terrasift.operators import quality
from terrasift.plans import tabular
from terrasift.sources import sinks, tables


def test_clean_file_counts_in_the_scan_that_writes(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(k, None if k % 3 == 0 else float(k)) for k in range(100)]
    frame = spark.createDataFrame(rows, "k long, v double").repartition(4)
    sinks.write_csv(frame, source)
    counts = tabular.clean_file(spark, source, target, frame.schema).first()
    assert tuple(counts) == (100, 66, 34)
    assert tables.read_csv(spark, target, frame.schema).count() == 66


def test_observed_counts_are_those_of_the_accounting(spark):
    frame = spark.range(1_000).select("id", F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("v"), F.lit(None).cast("string").alias("note"))
    kept, seen = quality.observed_accounting(frame, ["v"])
    assert kept.count() == 750
    assert quality.accounting_row(spark, seen).first() == quality.row_accounting(frame, ["v"]).first()


def test_bad_lines_by_file(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v,s\n1,2.5,x\n2,oops,y\n3,4\n4,5,z,more\n")
    (folder / "b.csv").write_text("k,v,s\n5,6,x\n")
    (folder / "empty.csv").write_text("k,v,s\n")
    read = tables.read_checked(spark, str(folder), "k long, v double, s string")
    got = {r["file"]: (r["rows"], r["bad_rows"], r["example"]) for r in tables.bad_record_accounting(read).collect()}
    assert got == {"a.csv": (4, 3, "2,oops,y"), "b.csv": (1, 0, None)}
    assert {(r.k, r.v) for r in read.collect()} == {(1, 2.5), (2, None), (3, 4.0), (4, 5.0), (5, 6.0)}
    with pytest.raises(FileNotFoundError, match="catalogue"):
        tables.read_checked(spark, str(tmp_path / "nothing"), "k long", name="catalogue")


def test_only_changed_classes_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(90).select("id", (F.col("id") % 3).cast("string").alias("c"))
    sinks.replace_partitions(frame, path, "c")
    before = {c: sorted(os.listdir(f"{path}/c={c}")) for c in "012"}
    sinks.replace_partitions(frame.filter("c = '1'").limit(5), path, "c")
    after = {c: sorted(os.listdir(f"{path}/c={c}")) for c in "012"}
    assert after["0"] == before["0"] and after["2"] == before["2"] and after["1"] != before["1"]
    assert {r.c: r["count"] for r in spark.read.parquet(path).groupBy(F.col("c").cast("string").alias("c")).count().collect()} == {"0": 30, "1": 5, "2": 30}
    sinks.replace_partitions(frame.limit(0), path, "c")
    assert spark.read.parquet(path).count() == 65
