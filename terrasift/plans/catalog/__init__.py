"""Queries over the driver's tables, each with the SQL it must agree with.

Importing this package fills ``QUERIES`` and ``ORACLE``.
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)``; without ``sql`` only its rows are checked."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


from terrasift.plans.catalog import (  # noqa: E402,F401
    charts, features, images, metrics, models, profiles, quality, splits, tables, text, training, trees)
