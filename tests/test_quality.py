import math

import pytest
from pyspark.sql import functions as F

from terrasift.operators import quality

NAN = float("nan")


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(10.0, 4.0, "a"), (NAN, 5.0, "b"), (12.0, None, "c")],
                                 "`震源深度(Km)` double, mL double, place string")


def test_drop_and_profile(gaps):
    assert quality.drop_missing(gaps).count() == 1
    assert quality.drop_missing(gaps, ["震源深度(Km)"]).count() == 2
    rows = {r["column"]: (r["nulls"], r["missing"]) for r in quality.missing_profile(gaps).collect()}
    assert rows == {"震源深度(Km)": (0, 1), "mL": (1, 1), "place": (0, 0)}
    assert quality.null_profile(gaps).first()["sum(mL)"] == 1
    assert quality.row_accounting(gaps).first().asDict() == {"rows_before": 3, "rows_after": 1, "rows_dropped": 2}
    assert quality.row_accounting(gaps, ["mL"]).first()["rows_after"] == 2


def test_tolerant_cast(spark):
    dirty = spark.createDataFrame([("5.0",), ("x",), ("4.6",), ("N/A",), (None,)], "`a.b` string")
    assert [r[0] for r in quality.cast_columns(dirty, ["a.b", "absent"]).collect()] == [5.0, None, 4.6, None, None]


def test_summary(spark):
    df = spark.createDataFrame([(1, "x"), (3, "y"), (None, None)], "n int, t string")
    rows = {r["column"]: r for r in quality.summary(df).collect()}
    assert (rows["n"]["count"], rows["n"]["mean"], rows["n"]["min"], rows["n"]["max"]) == (2, 2.0, 1.0, 3.0)
    assert math.isclose(rows["n"]["stddev"], math.sqrt(2))
    assert (rows["t"]["count"], rows["t"]["min_text"], rows["t"]["max_text"]) == (2, "x", "y")


def test_guards(gaps):
    with pytest.raises(ValueError, match="missing columns: Ms, mb"):
        quality.require_columns(gaps, ["mL", "Ms", "mb"])
    with pytest.raises(ValueError, match="needs 2"):
        quality.require_rows(gaps.filter(F.col("mL") == 5.0), 2)
    assert quality.require_rows(gaps, 2) is gaps


def test_projection_and_preview(gaps):
    out = quality.reshape_columns(gaps, {"mL": "features"}, ["place", "absent"])
    assert out.columns == ["震源深度(Km)", "features"]
    assert quality.preview(gaps, 2).count() == 2
    assert [r["column"] for r in quality.schema_overview(gaps).orderBy("position").collect()] == gaps.columns
