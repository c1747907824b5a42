"""Scaling, normalisation and projection of numeric features.

Two equivalent routes: column expressions (``scaled_table``) for tables that
are written or queried, all inside generated code, and MLlib stages
(``feature_stages``) for pipelines that end in a model.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.feature import PCA, MinMaxScaler, Normalizer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from terrasift.functions.numeric import quoted
from terrasift.functions.vectors import expand, vector_to_array
from terrasift.operators.quality import cast_columns, complete, drop_missing, require_columns

# Prefixes of the expanded columns.
SCALED_PREFIX = "MinMaxScaler_"
NORMAL_PREFIX = "normalized_"
# End of fixed values.


def assemble(df: DataFrame, columns, output="vector_compose_features", invalid="keep") -> DataFrame:
    """Feature vector column; ``keep`` turns null into NaN, ``skip`` drops the row."""
    require_columns(df, columns)
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def skip_accounting(df: DataFrame, columns) -> DataFrame:
    """Rows a ``skip`` assembly keeps and drops."""
    require_columns(df, columns)
    return df.agg(F.count_if(complete(df, columns)).alias("rows_kept"),
                  F.count_if(~complete(df, columns)).alias("rows_skipped"))


def fit_ranges(df: DataFrame, columns) -> dict:
    """Minimum and maximum per column in one aggregate, NaN and null ignored."""
    def real(c):
        return F.when(~F.isnan(quoted(c)), quoted(c))
    row = df.agg(*[f(real(c)).alias(f"{side}{i}") for i, c in enumerate(columns)
                   for f, side in ((F.min, "lo"), (F.max, "hi"))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def minmax_column(name: str, low, high):
    """Scale to [0, 1]; a constant column becomes 0.5, NaN stays NaN."""
    value = quoted(name)
    if low is None or low == high:
        return F.when(F.isnan(value), value).otherwise(F.when(value.isNotNull(), F.lit(0.5)))
    return (value - F.lit(low)) / F.lit(high - low)


def l2_norm(columns):
    return F.sqrt(reduce(add, [c * c for c in columns]))


def l2_column(column, norm):
    """A value divided by its row's Euclidean norm; a zero row stays zero."""
    return F.when(norm == 0, F.lit(0.0)).otherwise(column / norm)


def scaled_table(df: DataFrame, columns, keep=None, ranges=None, normalize=True) -> DataFrame:
    """Add ``MinMaxScaler_<c>`` and, when asked, ``normalized_<c>`` columns.

    ``ranges`` from an earlier fit scales new data the same way.
    """
    require_columns(df, columns)
    ranges = ranges or fit_ranges(df, columns)
    base = df.columns if keep is None else keep
    scaled = df.select(*[quoted(c) for c in dict.fromkeys([*base, *columns])],
                       *[minmax_column(c, *ranges[c]).alias(SCALED_PREFIX + c) for c in columns])
    names = [quoted(SCALED_PREFIX + c) for c in columns]
    if not normalize:
        return scaled.select(*[quoted(c) for c in base], *names)
    # The norm is a column of its own so that it is computed once per row.
    normed = scaled.select("*", l2_norm(names).alias("_norm"))
    return normed.select(*[quoted(c) for c in base], *names,
                         *[l2_column(n, F.col("_norm")).alias(NORMAL_PREFIX + c) for c, n in zip(columns, names)])


def feature_table(df: DataFrame, columns, keep=None) -> DataFrame:
    """Cast, drop incomplete rows, scale and normalise: one aggregate, one map."""
    require_columns(df, columns)
    return scaled_table(drop_missing(cast_columns(df, columns), list(columns)), columns, keep)


def expand_vector(df: DataFrame, vector_col: str, names, prefix="", drop=True) -> DataFrame:
    """One named column per vector element."""
    others = [quoted(c) for c in df.columns if not (drop and c == vector_col)]
    return df.select(*others, *expand(vector_to_array(quoted(vector_col)), names, prefix))


def clamp_k(k, n_features: int) -> int:
    """Number of components: anything outside 1..n means all; no features, none."""
    return k if k and 0 < k <= n_features else n_features


def feature_stages(columns, pca_k=None, scale=True, normalize=True, invalid="skip", output="features") -> list:
    """Assemble → min-max → L2 → PCA as pipeline stages ending in ``output``."""
    stages = [VectorAssembler(inputCols=list(columns), outputCol="assembled", handleInvalid=invalid)]
    if scale:
        stages.append(MinMaxScaler(inputCol="assembled", outputCol="scaled"))
    if normalize:
        stages.append(Normalizer(p=2.0, inputCol=stages[-1].getOutputCol(), outputCol="normal"))
    if pca_k is not None and clamp_k(pca_k, len(columns)):
        stages.append(PCA(k=clamp_k(pca_k, len(columns)), inputCol=stages[-1].getOutputCol(), outputCol="projected"))
    stages[-1].setOutputCol(output)
    return stages


def fit_pca(df: DataFrame, columns, k):
    """PCA model over ``columns``; ``None`` when there are no features."""
    if not columns:
        return None
    ready = assemble(df, columns, "features", "skip")
    return PCA(k=clamp_k(k, len(columns)), inputCol="features", outputCol="pca_features").fit(ready)


def pca_project(df: DataFrame, columns, k, keep=None) -> DataFrame:
    """Projected columns ``pc1..pck`` (not centred, as MLlib projects)."""
    model = fit_pca(df, columns, k)
    projected = model.transform(assemble(df, columns, "features", "skip"))
    base = df.columns if keep is None else keep
    parts = vector_to_array(F.col("pca_features"))
    return projected.select(*[quoted(c) for c in base], *[parts[i].alias(f"pc{i + 1}") for i in range(model.getK())])


def explained_variance(df: DataFrame, columns, k) -> DataFrame:
    """Share of the variance per component."""
    ratios = fit_pca(df, columns, k).explainedVariance.toArray()
    rows = [(i + 1, float(r)) for i, r in enumerate(ratios)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double")
