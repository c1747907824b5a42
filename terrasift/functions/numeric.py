"""Missing values, tolerant casts and scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by exact name; catalogue headers hold ``()``, ``°`` and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_double(name: str) -> Column:
    """Text that is not a number becomes null instead of failing the job."""
    return quoted(name).try_cast("double")


def is_missing(name: str, dtype: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    column = quoted(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def within(label: Column, prediction: Column, threshold: float) -> Column:
    """True where the prediction is off by at most ``threshold`` (inclusive)."""
    return (label - prediction).between(-threshold, threshold)


def true_share(flag: Column) -> Column:
    """Share of true among non-null flags; null when there are none."""
    return F.avg(flag.cast("double"))
