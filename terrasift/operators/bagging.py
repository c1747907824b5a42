"""Forests whose bags come from the rows themselves.

Row ``r`` is in tree ``t`` as often as a Poisson draw from the MD5 of (seed, t,
key) says. A bag is therefore the same however the table is partitioned, cached
or recomputed after a lost executor, and for any setting of the session. Columns
with more values than bins are cut at exact quantiles first, so that no split
candidate is sampled either.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrasift.functions.hashing import key_text, row_hash, seeded_hash, unit_interval
from terrasift.functions.numeric import quoted
from terrasift.operators import counted
from terrasift.operators.counted import MOST_COPIES, POISSON, copies  # noqa: F401
from terrasift.operators.models import CV_PARALLELISM, MODEL_SEED
from terrasift.operators.quality import require_columns
from terrasift.operators.ranks import exact_quantiles
from terrasift.session import stage_table

def tree_weight(key_cols, tree: int, seed=MODEL_SEED) -> Column:
    return copies(unit_interval(row_hash(key_cols, f"{seed}.{tree}")))


def quantile_cuts(df: DataFrame, columns, bins: int) -> dict:
    """Per column the values that part it into at most ``bins`` bins of equal size; none where it has few values."""
    columns = list(columns)
    counts = df.agg(*[F.approx_count_distinct(quoted(c), 0.01).alias(f"n{k}") for k, c in enumerate(columns)]).first()
    out = {}
    for k, c in enumerate(columns):
        if counts[k] * 1.05 > bins:
            row = exact_quantiles(df.select(quoted(c).cast("double").alias("v")), "v", [b / bins for b in range(1, bins)]).first()
            out[c] = sorted({row[f"q{b}"] for b in range(bins - 1)} - {None}) if row else []
    return out


@dataclass
class HashedForest:
    columns: list
    cuts: dict
    trees: list

    def _features(self, df: DataFrame, output: str) -> DataFrame:
        names = [f"{output}_{k}" for k in range(len(self.columns))]
        binned = df.select("*", *[self._binned(c).alias(name) for c, name in zip(self.columns, names)])
        return VectorAssembler(inputCols=names, outputCol=output, handleInvalid="keep").transform(binned).drop(*names)

    def _binned(self, column: str) -> Column:
        value, cuts = quoted(column).cast("double"), self.cuts.get(column)
        if not cuts:
            return value
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < value)).cast("double")

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the mean of the trees' predictions.

        Where rows share their bins, the trees predict every combination once and the rows are joined with it.
        """
        bins = counted.Bins(self.columns, len(self.columns), {})
        placed = df.select("*", *[F.coalesce(self._binned(c), F.lit(float("nan"))).alias(n) for c, n in zip(self.columns, bins.names)])
        facts = placed.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*bins.names))).first()
        if facts[1] * counted.ROWS_PER_GROUP > facts[0]:
            return self._scored(placed, bins, output).drop(*bins.names)
        found = self._scored(stage_table(placed.select(*bins.names).distinct(), "combinations"), bins, output)
        scores = stage_table(found, "combination-scores")
        return placed.join(scores, bins.names, "left").select(*[quoted(c) for c in df.columns], output)

    def _scored(self, placed: DataFrame, bins, output: str) -> DataFrame:
        return counted.CountedModel(bins, self.trees, {}).scored(placed, output)

    def save(self, path: str) -> None:
        """One saved tree per folder; the columns and cuts are rows of a small table."""
        for t, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/tree-{t:05d}")
        rows = [(k, c, [float(x) for x in self.cuts.get(c, [])], len(self.trees)) for k, c in enumerate(self.columns)]
        SparkSession.active().createDataFrame(rows, "at int, name string, cuts array<double>, trees int").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @classmethod
    def load(cls, path: str) -> "HashedForest":
        rows = SparkSession.active().read.parquet(f"{path}/columns").orderBy("at").collect()
        trees = [RandomForestRegressionModel.load(f"{path}/tree-{t:05d}") for t in range(rows[0]["trees"])]
        return cls([r["name"] for r in rows], {r["name"]: r["cuts"] for r in rows if r["cuts"]}, trees)


def fit_hashed_forest(df: DataFrame, columns, label: str, key_cols, trees: int = 20, bins: int = 32, features_per_split: str = "auto",
                      seed=MODEL_SEED, parallelism=CV_PARALLELISM, **params) -> HashedForest:
    """Fit ``trees`` regression trees, each on its own bag, side by side.

    Rows with equal keys share their draws, so keys should tell rows apart. ``features_per_split`` is MLlib's
    ``featureSubsetStrategy``; ``auto`` means a third of the columns.
    """
    columns, bins_asked = list(columns), bins
    require_columns(df, [*columns, label, *key_cols])
    forest = HashedForest(columns, quantile_cuts(df, columns, bins), [])
    subset = "onethird" if features_per_split == "auto" and len(columns) > 1 else features_per_split
    needed = [quoted(c) for c in dict.fromkeys([*columns, label, *key_cols])]
    bins = counted.Bins(columns, len(columns), {})
    placed = df.select(*needed).select("*", *[F.coalesce(forest._binned(c), F.lit(float("nan"))).alias(n) for c, n in zip(columns, bins.names)])
    facts = placed.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*bins.names))).first()
    spark = df.sparkSession

    def tree_fit(tree: int, bag: DataFrame, at: str, of: str, weight: str):
        return RandomForestRegressor(
            featuresCol=at, labelCol=of, weightCol=weight, numTrees=1, bootstrap=False, maxBins=max(bins_asked, 2) + 4,
            featureSubsetStrategy="all" if subset == "auto" else subset, seed=seed + tree, **params).fit(bag)

    if facts[1] * counted.ROWS_PER_GROUP <= facts[0] and params.get("minInstancesPerNode", 1) == 1:
        # The draws of all trees are counted by bins in one pass; a tree's fit then reads its counts.
        rows = placed.select(*bins.names, counted._label(label).alias("_y"), key_text(key_cols).alias(counted.ROW_KEY))
        hashed = seeded_hash(F.concat(F.lit(f"{seed}."), F.col(counted.TREE).cast("string")), F.col(counted.ROW_KEY))
        for batch, read in counted.bag_batches(rows, bins, unit_interval(hashed), trees):
            def one(tree, read=read):
                part, size = read(tree)
                return tree_fit(tree, counted.fit_rows(bins, part, size), counted.BINNED, counted.MEAN, counted.ROWS)
            with ThreadPool(min(parallelism, len(batch))) as pool:
                forest.trees += pool.map(inheritable_thread_target(spark)(one), batch, chunksize=1)
        return forest

    rows = forest._features(df.select(*needed), "_bagged").persist(StorageLevel.MEMORY_AND_DISK)

    def fit(tree: int):
        bag = rows.withColumn("_weight", tree_weight(key_cols, tree, seed)).filter("_weight > 0").select("_bagged", quoted(label), "_weight")
        return tree_fit(tree, bag, "_bagged", label, "_weight")

    try:
        with ThreadPool(min(parallelism, trees)) as pool:
            forest.trees = pool.map(inheritable_thread_target(spark)(fit), range(trees))
    finally:
        rows.unpersist()
    return forest
