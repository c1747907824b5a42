"""Jobs on earthquake tables: clean, build features, compare models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrasift.functions.numeric import quoted
from terrasift.operators import counted, features, models, quality, splits
from terrasift.registry import DatasetSpec, dataset
from terrasift.sources import headers, sinks, sniff, tables


def clean_file(spark: SparkSession, source: str, target: str, schema=None, name=None) -> DataFrame:
    """Read a CSV, drop incomplete rows, write the rest; returns the row accounting, counted while writing."""
    kept, seen = quality.observed_accounting(tables.read_csv(spark, source, schema, name=name))
    sinks.write_csv(kept, target)
    return quality.accounting_row(spark, seen)


def build_features(df: DataFrame, spec: DatasetSpec, target: str | None = None, single_file=False) -> DataFrame:
    """Cast, clean, scale and normalise a dataset's features; optionally write them.

    Stops with an error when columns are missing or nothing is left after
    cleaning, before anything is written.
    """
    columns = headers.resolve_columns(spec.features, df.columns)
    quality.require_columns(df, columns)
    clean = quality.drop_missing(quality.cast_columns(df, columns), columns)
    quality.require_rows(clean, 1, spec.name)
    table = features.scaled_table(clean, columns)
    if target:
        path = f"{target.rstrip('/')}/{sinks.normalized_name(spec.name)}"
        (sinks.write_single_csv if single_file else sinks.write_csv)(table, path)
    return table


def compare_models(df: DataFrame, spec: DatasetSpec, key_cols=None, candidates=None, seed=splits.SPLIT_SEED) -> DataFrame:
    """Leaderboard of the four regressors on one dataset.

    Features are fitted on the training rows only, so nothing of the test rows
    (nor the label) reaches the model. Without ``key_cols`` a row is its own key.
    """
    key_cols = key_cols or df.columns
    columns = headers.resolve_columns(spec.features, df.columns)
    needed = [*columns, spec.label]
    quality.require_columns(df, needed)
    ready = quality.drop_missing(quality.cast_columns(df, needed), needed)
    large = ready.count() >= counted.LEAST_ROWS
    if large:  # keys and what is compared are all that is read again
        ready = ready.select(*[quoted(c) for c in dict.fromkeys([*key_cols, *needed])])
    train, test = splits.random_parts(ready, key_cols, seed=seed, staged=large)
    quality.require_rows(train, 2, f"{spec.name} train")
    quality.require_rows(test, 1, f"{spec.name} test")
    pipeline = models.fit_features(train, columns, spec.pca_k, staged=large)
    return models.leaderboard(pipeline.transform(train), pipeline.transform(test),
                              candidates or models.candidates(spec.label), spec.label, key_cols, spec.folds)


def train_dataset(spark: SparkSession, name: str, path: str, key_cols=None, target: str | None = None, **params) -> tuple:
    """Train on a file of a registered dataset: ``(predictions, rmse)``.

    The file's encoding and separator are settled first. Types are not inferred:
    the registry names the numbers that training needs. With ``target`` the label
    and prediction of every row are written as CSV.
    """
    spec = dataset(name)
    df = headers.clean_headers(sniff.read_delimited(spark, path, infer=False))
    columns = headers.resolve_columns(spec.features, df.columns)
    actual = DatasetSpec(spec.name, columns, spec.label, spec.pca_k, spec.folds)
    scored, rmse = models.train_and_score_all(df, actual, key_cols, **params)
    if target:
        sinks.write_label_predictions(scored, target, spec.label)
    return scored, rmse


def ingest(spark: SparkSession, sources: dict, schemas=None) -> DataFrame:
    """Row accounting of many CSV datasets; failures become status rows."""
    schemas = schemas or {}
    return tables.ingest_all(
        spark, {n: (lambda n=n: tables.read_csv(spark, sources[n], schemas.get(n), name=n)) for n in sources},
        quality.row_accounting)
