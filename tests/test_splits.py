import hashlib
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from terrasift.operators import splits


def _expected(rows, train, val):
    """Exact floor sizes per class, whatever keys repeat."""
    out = Counter()
    for cls, n in Counter(cls for cls, _ in rows).items():
        c1, c2 = math.floor(train * n), math.floor(val * n)
        out += Counter({(cls, "train"): c1, (cls, "val"): c2, (cls, "test"): n - c1 - c2})
    return out


def _got(df):
    return Counter({(r["cls"], r["split"]): r["n"] for r in splits.split_sizes(df, "cls").collect()})


def test_ten_per_class(spark):
    df = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("cls"))
    got = _got(splits.stratified_split(df, "cls", ["id"]))
    assert all((got[(str(c), s)] == n) for c in range(4) for s, n in (("train", 7), ("val", 1), ("test", 2)))


@pytest.mark.parametrize("digits", [1, 4])
def test_hot_class_null_class_and_copies(spark, digits):
    rows = [("hot", i) for i in range(700)] + [("cold", i) for i in range(11)] + [("one", 0)]
    rows += [(None, i) for i in range(20)] + [("copies", 5)] * 60 + [("copies", i) for i in range(100, 140)]
    df = spark.createDataFrame(rows, "cls string, key int").repartition(5)
    out = splits.stratified_split(df, "cls", ["key"], digits=digits)
    assert out.count() == len(rows)
    assert _got(out) == _expected(rows, 0.7, 0.15)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 60), min_size=1, max_size=4), train=st.sampled_from([0.0, 0.5, 0.7, 1.0]))
def test_exact_floor_sizes(spark, sizes, train):
    rows = [(str(c), i) for c, n in enumerate(sizes) for i in range(n)]
    val = min(0.15, 1 - train)
    df = spark.createDataFrame(rows, "cls string, key int")
    got = _got(splits.stratified_split(df, "cls", ["key"], train, val))
    for c, n in enumerate(sizes):
        assert got[(str(c), "train")] == math.floor(train * n)
        assert got[(str(c), "val")] == math.floor(val * n)
        assert sum(got[(str(c), s)] for s in ("train", "val", "test")) == n


@pytest.mark.parametrize("n,test", [(2, 1), (4, 1), (10, 2), (11, 3), (100, 20)])
def test_holdout(spark, n, test):
    out = splits.holdout_split(spark.range(n), ["id"])
    assert out.filter("split = 'test'").count() == test and out.count() == n


def test_random_split_does_not_depend_on_partitions(spark):
    parts = [{r["id"] for r in splits.random_parts(spark.range(2000).repartition(k), ["id"])[0].collect()} for k in (1, 7)]
    assert parts[0] == parts[1] and 1500 < len(parts[0]) < 1700


def test_ratio_checks():
    assert splits.check_ratios(0.7, 0.15)[2] == pytest.approx(0.15)
    for bad in ((0.7, 0.2, 0.2), (1.2, 0.0, -0.2), (-0.1, 0.5, 0.6), (0.9, 0.2, None)):
        with pytest.raises(ValueError):
            splits.check_ratios(*bad)


def test_unique_keys_are_cut_in_hash_order(spark):
    def order(k):
        return hashlib.md5(f"{splits.SPLIT_SEED}|{len(str(k))}:{k}".encode()).hexdigest()
    ranked = sorted(range(300), key=order)
    df = spark.range(300).select("id", F.lit("c").alias("cls"))
    got = {r["id"]: r["split"] for r in splits.stratified_split(df, "cls", ["id"], digits=1).collect()}
    assert [got[k] for k in ranked] == ["train"] * 210 + ["val"] * 45 + ["test"] * 45


def test_equal_rows_still_leave_a_test_row(spark):
    equal = spark.range(10, numPartitions=4).select(F.lit("same").alias("v"))
    sizes = {r["split"]: r["n"] for r in splits.split_sizes(splits.holdout_split(equal, ["v"])).collect()}
    assert sizes == {"train": 8, "test": 2}
    hot = spark.range(100).select(F.lit("c").alias("cls"), F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("k"), "id")
    assert _got(splits.stratified_split(hot, "cls", ["k"])) == Counter({("c", "train"): 70, ("c", "val"): 15, ("c", "test"): 15})


def test_small_buckets_are_split_further(spark):
    from terrasift.functions.hashing import row_hash
    from terrasift.operators.ranks import hash_thresholds
    hashed = spark.range(500).select(F.lit("s").alias("s0"), row_hash(["id"], 1).alias("h"))
    def cuts(n):
        return [F.floor(n * 0.5), F.floor(n * 0.9)]
    few = hash_thresholds(hashed, ["s0"], cuts, digits=1, rows_per_bucket=3).first()
    assert few == hash_thresholds(hashed, ["s0"], cuts).first()


def test_row_hash_keeps_nulls_and_separators_apart(spark):
    from terrasift.functions.hashing import row_hash
    rows = [("a", None, "b"), ("a", "b", None), ("a|1:b", None, None), (None, "a", "b"), ("null", "a", "b"), ("a", "", "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(row_hash(["x", "y", "z"], 1).alias("h")).distinct().count() == len(rows)
