import numpy as np
import pytest

from terrasift.operators import profiles


def test_merged_batches_are_the_whole(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=20_000), np.full(10_000, 3.5)])
    rng.shuffle(values)
    rows = [(int(k % 7), float(v) if k % 10 else None) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "day int, v double").repartition(6)
    stored = profiles.batch_profiles(df.filter("day < 4"), ["v"], "day").unionByName(profiles.batch_profiles(df.filter("day >= 4"), ["v"], "day"))
    assert stored.count() == 7
    levels = (0.01, 0.25, 0.5, 0.9, 0.99)
    row = profiles.merged_profiles(stored, levels).first()
    filled = np.sort([v for _, v in rows if v is not None])
    assert (row.rows, row.nulls, row.least, row.most) == (30_000, 3_000, filled[0], filled[-1])
    assert row["mean"] == pytest.approx(filled.mean())
    for level, got in zip(levels, row.quantiles):
        low, high = np.searchsorted(filled, got, "left") / len(filled), np.searchsorted(filled, got, "right") / len(filled)
        assert low - profiles.RANK_ERROR <= level <= high + profiles.RANK_ERROR
    assert row.distincts == pytest.approx(len(set(filled)) + 1, rel=profiles.DISTINCT_ERROR)


def test_columns_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "day int, v double")
    row = profiles.merged_profiles(profiles.batch_profiles(df, ["v"], "day")).first()
    assert (row.rows, row.nulls, row.least, row["mean"], row.quantiles) == (2, 2, None, None, None)
    assert profiles.batch_profiles(df.limit(0), ["v"], "day").count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        profiles.batch_profiles(df, ["w"], "day")
