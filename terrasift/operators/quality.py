"""Schema checks, profiles, tolerant casts and missing-value handling."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql import types as T

from terrasift.functions.numeric import is_missing, quoted, to_double

log = logging.getLogger(__name__)


def schema_overview(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def _long(one_row: DataFrame, entries) -> DataFrame:
    """Turn a one-row aggregate into one row per column without a second pass."""
    return one_row.select(F.inline(F.array(*[F.struct(*e) for e in entries])))


def _summary_of(df, fields, numeric):
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    aggs, entries = [], []
    for i, field in enumerate(fields):
        value = quoted(field.name)
        aggs += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
        if numeric:
            aggs += [F.avg(value).alias(f"mu{i}"), F.stddev(value).alias(f"sd{i}")]
            stats = [F.col(f"{s}{i}").cast("double") for s in ("mu", "sd", "lo", "hi")] + [no_text, no_text]
        else:
            stats = [no_number] * 4 + [F.col(f"lo{i}"), F.col(f"hi{i}")]
        labels = ("mean", "stddev", "min", "max", "min_text", "max_text")
        entries.append([F.lit(field.name).alias("column"), F.col(f"n{i}").alias("count"),
                        *[s.alias(label) for s, label in zip(stats, labels)]])
    return _long(df.agg(*aggs), entries)


def summary(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, stddev, min and max per numeric or text column.

    Text columns have ``min_text``/``max_text`` instead of numeric statistics.
    Numbers and text are separate aggregates: each reads only its own columns,
    and text extremes would push the numbers out of hash aggregation.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numbers = [f for f in fields if isinstance(f.dataType, T.NumericType)]
    texts = [f for f in fields if isinstance(f.dataType, T.StringType)]
    parts = [_summary_of(df, part, numeric) for part, numeric in ((numbers, True), (texts, False)) if part]
    if not parts:
        raise ValueError("no numeric or text columns to summarise")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """Per column: nulls, and missing values (null or NaN), in one scan."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs, entries = [], []
    for i, f in enumerate(fields):
        aggs += [F.count_if(quoted(f.name).isNull()).alias(f"null{i}"),
                 F.count_if(is_missing(f.name, f.dataType)).alias(f"miss{i}")]
        entries.append([F.lit(f.name).alias("column"), F.col(f"null{i}").alias("nulls"),
                        F.col(f"miss{i}").alias("missing")])
    return _long(df.agg(*aggs), entries)


def null_profile(df: DataFrame) -> DataFrame:
    """One row; column ``sum(<c>)`` is the number of nulls (not NaN) in ``c``."""
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(f"sum({c})") for c in df.columns])


def drop_missing(df: DataFrame, columns=None) -> DataFrame:
    """Drop rows with a null or NaN in any column, or in any of ``columns``.

    Same rows as ``na.drop``, but as plain ``IS NOT NULL`` conditions, which
    reach a Parquet scan.
    """
    if columns is not None:
        require_columns(df, columns)
    return df.filter(complete(df, columns))


def complete(df: DataFrame, columns=None):
    """Column that is true where no listed value is null or NaN."""
    flag = F.lit(True)
    for f in df.schema.fields:
        if columns is None or f.name in columns:
            flag = flag & ~is_missing(f.name, f.dataType)
    return flag


def row_accounting(df: DataFrame, columns=None) -> DataFrame:
    """Rows before and after :func:`drop_missing`, from one scan."""
    return df.agg(F.count("*").alias("rows_before"),
                  F.count_if(complete(df, columns)).alias("rows_after")) \
             .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def observed_accounting(df: DataFrame, columns=None) -> tuple[DataFrame, Observation]:
    """Complete rows, and an observation of the counts of :func:`row_accounting`.

    The counts are gathered while the returned rows are read by their first action, so
    writing a cleaned table and accounting for it is one scan. Tasks that are run again count once.
    """
    kept = complete(df, columns)
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after"))
    return watched.filter(kept), seen


def accounting_row(spark, seen: Observation) -> DataFrame:
    """The counts of an observation whose action is done, as :func:`row_accounting` gives them."""
    counts = seen.get
    before, after = counts["rows_before"], counts["rows_after"]
    return spark.createDataFrame([(before, after, before - after)], "rows_before long, rows_after long, rows_dropped long")


def cast_columns(df: DataFrame, columns) -> DataFrame:
    """Listed columns to double, bad text to null; unknown names are skipped."""
    for name in columns:
        if name not in df.columns:
            log.warning("no column %r to cast", name)
    wanted = set(columns)
    return df.select(*[to_double(c).alias(c) if c in wanted else quoted(c) for c in df.columns])


def require_columns(df: DataFrame, columns) -> DataFrame:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}; present: {', '.join(df.columns)}")
    return df


def require_rows(df: DataFrame, at_least=1, what="table") -> DataFrame:
    """Stop when fewer than ``at_least`` rows are left (reads no more than that)."""
    found = df.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"{what} has {found} usable rows, needs {at_least}")
    return df


def reshape_columns(df: DataFrame, rename=None, drop=()) -> DataFrame:
    """Rename columns and drop those that exist, in one projection."""
    names = rename or {}
    return df.select(*[quoted(c).alias(names.get(c, c)) for c in df.columns if c not in set(drop)])


def preview(df: DataFrame, n=20, order_by=None) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)
