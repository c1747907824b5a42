"""Trees fitted on counted bins: a fit costs what its bins cost, not its rows.

MLlib looks for splits only between the at most ``maxBins`` bins of a column, and
the gain of a split by squared error rests on the count and the mean label of the
rows in every combination of bins. So one pass counts the combinations, and the
fit iterates over these. Bins end at exact quantiles of all rows; a column with
no more values than bins keeps its values. Rows are bagged one by one, in the
pass that counts them.

A table whose rows hardly share bins gains nothing; :func:`settle` then returns
None, and the rows themselves are fitted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrasift.functions.numeric import quoted
from terrasift.functions.vectors import vector_to_array
from terrasift.operators import draws
from terrasift.operators.draws import MOST_COPIES, POISSON
from terrasift.operators.ranks import exact_quantiles
from terrasift.session import scratch_path, stage_table

LEAST_ROWS = 100_000     # smaller tables are fitted row by row
LEAST_BAGGED = 1_000_000  # as LEAST_ROWS, for forests with bags: each of their trees is a fit of its own
ROWS_PER_GROUP = 8       # rows that a combination of bins must hold on average
BAG_ROWS = 4_000_000     # counted rows of all trees that are bagged in one pass
DEAL_GROUPS = 20_000     # combinations of bins from which on rows are dealt by them before they are bagged
FIT_ROWS = 20_000        # counted rows in a partition of a fit
TREE_ROWS = 250_000      # as FIT_ROWS, for the trees of a forest, many of which are fitted at a time
PARALLELISM = 8          # fits side by side; each is a run of small jobs
ROWS, MEAN, SPREAD, TREE, ROW_KEY, BINNED = "_rows", "_mean", "_spread", "_tree", "_row_key", "_binned"


def copies(draw: Column) -> Column:
    """Poisson number with mean 1 for a uniform draw: how many cumulative probabilities it reaches."""
    number = F
    for k, p in enumerate(POISSON):
        number = number.when(draw < F.lit(p), F.lit(float(k)))
    return number.otherwise(F.lit(float(MOST_COPIES)))


def cuts_of(df: DataFrame, columns, bins: int) -> dict:
    """Inner quantiles of every column, at exact ranks; all columns are read in one pass."""
    columns = list(columns)
    if not columns:
        return {}
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("_column"), quoted(c).cast("double").alias("_value")) for k, c in enumerate(columns)])))
    found = {r["_column"]: r for r in exact_quantiles(pairs, "_value", [b / bins for b in range(1, bins)], ["_column"]).collect()}
    return {c: sorted({found[k][f"q{b}"] for b in range(bins - 1)} - {None}) if k in found else [] for k, c in enumerate(columns)}


@dataclass
class Bins:
    """Columns, or the elements of a vector column, and where each is cut; uncut ones keep their values."""
    features: object
    width: int
    cuts: dict
    rows: int = 0  # of the table they were settled on

    @property
    def names(self) -> list:
        return [f"_bin{k}" for k in range(self.width)]

    def values(self, df: DataFrame) -> DataFrame:
        """Add the values as plain doubles; null becomes NaN."""
        if isinstance(self.features, str):
            df = df.withColumn("_elements", vector_to_array(quoted(self.features)))
            found = [F.col("_elements")[k] for k in range(self.width)]
        else:
            found = [quoted(c).cast("double") for c in self.features]
        return df.select("*", *[F.coalesce(v, F.lit(float("nan"))).alias(n) for v, n in zip(found, self.names)]).drop("_elements")

    def add(self, df: DataFrame) -> DataFrame:
        """Add ``_bin<k>``. NaN stays NaN, which MLlib's fits refuse and its trees predict from the right."""
        cut = [n for n in self.names if self.cuts.get(n)]
        valued = self.values(df)
        if not cut:
            return valued
        top = valued.withColumns({f"{n}_was": F.col(n) for n in cut} | {n: F.when(F.isnan(n), F.lit(math.inf)).otherwise(F.col(n)) for n in cut})
        out = [f"{n}_at" for n in cut]
        placed = Bucketizer(splitsArray=[[-math.inf, *self.cuts[n], math.inf] for n in cut], inputCols=cut, outputCols=out).transform(top)
        held = valued.columns
        kept = [F.when(F.isnan(f"{n}_was"), F.col(f"{n}_was")).otherwise(F.col(f"{n}_at")).alias(n) if n in cut else quoted(n) for n in held]
        return placed.select(*kept)

    def vectors(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.names, outputCol=BINNED, handleInvalid="keep").transform(df)


def settle(df: DataFrame, features, bins: int, least: int = LEAST_ROWS) -> Bins | None:
    """Bins of the table, or None where it is small or its rows hardly share combinations of bins."""
    if isinstance(features, str):
        head = df.select(F.size(vector_to_array(quoted(features))).alias("n")).first()
        if head is None:
            return None
        found = Bins(features, head["n"], {})
    else:
        found = Bins(list(features), len(features), {})
    valued = found.values(df)
    facts = valued.agg(F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(n).alias(n) for n in found.names]).first()
    if facts["rows"] < least:
        return None
    found.rows = facts["rows"]
    wide = [n for n in found.names if facts[n] * 1.15 > bins]
    found.cuts = {n: [c for c in cuts if math.isfinite(c)] for n, cuts in cuts_of(valued.select(*wide), wide, bins).items()} if wide else {}
    groups = math.prod(min(bins, facts[n] * 1.15) for n in found.names)
    if groups * ROWS_PER_GROUP > facts["rows"]:
        groups = found.add(df).agg(F.approx_count_distinct(F.xxhash64(*found.names))).first()[0]
    return found if groups * ROWS_PER_GROUP <= facts["rows"] else None


def suits(estimator) -> bool:
    """Whether counts and means hold all that the estimator reads of the rows."""
    if not isinstance(estimator, (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)) or estimator.isSet("weightCol"):
        return False
    if isinstance(estimator, GBTRegressor) and (estimator.getLossType() != "squared" or estimator.isSet("validationIndicatorCol")):
        return False
    return getattr(estimator, "getSubsamplingRate", lambda: 1.0)() == 1.0


def least_rows(estimator) -> int:
    return LEAST_BAGGED if isinstance(estimator, RandomForestRegressor) and estimator.getBootstrap() else LEAST_ROWS


def _label(label: str) -> Column:
    return F.coalesce(quoted(label).cast("double"), F.lit(float("nan")))  # MLlib refuses NaN, and no mean hides it


def count_rows(df: DataFrame, bins: Bins, label: str, by=()) -> DataFrame:
    """Rows, mean label and squared spread around it of every combination of bins, and of ``by``."""
    rows = bins.add(df).select(*by, *bins.names, _label(label).alias("_y"))
    counts = rows.groupBy(*by, *bins.names).agg(
        F.count(F.lit(1)).cast("double").alias(ROWS), F.avg("_y").alias(MEAN), (F.var_pop("_y") * F.count(F.lit(1))).alias(SPREAD))
    return stage_table(counts, "counted")


def row_key(columns) -> Column:
    """What the draws of a row rest on; rows equal in all ``columns`` share them."""
    return F.xxhash64(*[quoted(c) for c in columns])


def draw(seed: int) -> Column:
    """Uniform number of a row and a tree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(ROW_KEY), F.col(TREE)), 11) * F.lit(2.0 ** -53)


def count_bags(rows: DataFrame, bins: Bins, trees, chance: Column, by=()) -> str:
    """Folder with a part ``_tree=<t>`` for each tree: its counted rows, drawn one by one.

    ``rows`` has the bins, ``_y``, ``by`` and what ``chance``, the uniform draw of a row and a tree, reads.
    """
    each = rows.select("*", F.explode(F.array(*[F.lit(t) for t in trees])).alias(TREE))
    drawn = each.select(TREE, *by, *bins.names, "_y", chance.alias("_u")).select(TREE, *by, *bins.names, "_y", copies(F.col("_u")).alias("_w"))
    return write_bags(drawn.select(TREE, *by, *bins.names, F.col("_w").alias(ROWS), (F.col("_w") * F.col("_y")).alias(draws.SUM)), bins, by)


def write_bags(drawn: DataFrame, bins: Bins, by=()) -> str:
    """Folder with a part for each tree: rows and mean label of every combination, from parts of their sums."""
    counts = drawn.groupBy(TREE, *by, *bins.names).agg(F.sum(ROWS).alias(ROWS), F.sum(draws.SUM).alias(draws.SUM)).filter(F.col(ROWS) > 0)
    path = scratch_path(drawn.sparkSession, "bags")
    counts.withColumn(MEAN, F.col(draws.SUM) / F.col(ROWS)).drop(draws.SUM).repartition(TREE).write.partitionBy(TREE).parquet(path)
    return path


def _reader(spark, path: str):
    """Reader of a tree's counted rows and their number."""
    def read(tree):
        part = spark.read.parquet(f"{path}/{TREE}={tree}")
        return part, part.count()
    return read


def _ready(estimator, total: float, **params):
    """The estimator on counted rows: least rows of a node become a least weight."""
    out = estimator.copy(params.pop("extra", {}))
    least = out.getMinInstancesPerNode()
    if least > 1:
        share = max(out.getMinWeightFractionPerNode(), (least - 0.5) / total)
        out = out.copy({out.minInstancesPerNode: 1, out.minWeightFractionPerNode: min(share, 0.499999)})
    return out._set(featuresCol=BINNED, labelCol=MEAN, weightCol=ROWS, **params)


def one_tree(forest, tree: int, seed: int) -> dict:
    """Parameters of a forest's tree ``tree``, which gets its bag as counted rows."""
    subset = forest.getFeatureSubsetStrategy()
    return {forest.numTrees: 1, forest.bootstrap: False, forest.seed: seed + tree,
            forest.featureSubsetStrategy: "onethird" if subset == "auto" else subset}


@dataclass
class CountedModel:
    """Fitted MLlib models whose mean is the prediction, and the bins they read."""
    bins: Bins
    models: list
    chosen: dict
    errors: list = field(default_factory=list)  # mean RMSE of every cell of the grid

    def scored(self, df: DataFrame, output="prediction", many=()) -> DataFrame:
        """Predict for rows that have the bins; ``many`` adds the mean of the first trees, for each number in it."""
        df, names = self.bins.vectors(df), [f"_part{k}" for k in range(len(self.models))]
        for model, name in zip(self.models, names):
            df = model.setFeaturesCol(BINNED).setPredictionCol(name).transform(df)

        def mean(n):
            return sum((F.col(c) for c in names[1:n]), F.col(names[0])) / n
        return df.select("*", mean(len(names)).alias(output), *[mean(n).alias(f"_first{n}") for n in many]).drop(BINNED, *names)

    def transform(self, df: DataFrame, output="prediction") -> DataFrame:
        """Add the prediction. Many trees predict each combination of bins once, and the rows are joined with it."""
        binned, names = self.bins.add(df), self.bins.names
        if len(self.models) == 1:
            return self.scored(binned, output).drop(*names)
        found = self.scored(stage_table(binned.select(*names).distinct(), "combinations"), output)
        return binned.join(stage_table(found.select(*names, output), "combination-scores"), names, "left").select(*[quoted(c) for c in df.columns], output)


def _side_by_side(spark, work, items) -> list:
    items = list(items)
    with ThreadPool(max(1, min(PARALLELISM, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def fit_rows(bins: Bins, df: DataFrame, rows: int, each: int = FIT_ROWS) -> DataFrame:
    """Counted rows as a fit reads them, dealt by their bins."""
    parts = max(1, -(-rows // each))
    return bins.vectors(df.repartition(parts, *bins.names) if parts > 1 else df.coalesce(1))


def bag_rows(df: DataFrame, bins: Bins, label: str, key_cols, seed: int, groups: int, by=()) -> DataFrame:
    """Rows as their draws read them, staged; with many combinations of bins, those of one lie together.

    A hot combination is dealt over tasks by the hash of its rows. ``df`` may hold that hash in ``_row_key``.
    """
    key = F.col(ROW_KEY) if ROW_KEY in df.columns else row_key([*dict.fromkeys([*key_cols, label])]).alias(ROW_KEY)
    placed = bins.add(df.select("*", key) if ROW_KEY not in df.columns else df)
    rows = placed.select(*by, *bins.names, _label(label).alias(draws.LABEL), F.xxhash64(F.lit(seed), F.col(ROW_KEY)).alias(draws.BASE),
                         F.xxhash64(*by, *bins.names).alias(draws.GROUP))
    if groups >= DEAL_GROUPS:
        rows = rows.repartitionByRange(max(1, -(-bins.rows // draws.CHUNK_ROWS)), draws.GROUP, draws.BASE)
    return stage_table(rows, "bag-rows")


def bag_trees(rows: DataFrame, bins: Bins, groups: int, count: int, by=()):
    """Yield (trees, reader of a tree's counted rows) of :func:`bag_rows`, as many trees at a time as ``BAG_ROWS`` allows."""
    step = max(1, BAG_ROWS // max(1, groups))
    for done in range(0, count, step):
        trees = range(done, min(count, done + step))
        drawn = draws.drawn_sums(rows, [*by, *bins.names], trees, TREE, ROWS)
        yield trees, _reader(rows.sparkSession, write_bags(drawn, bins, by))


def bag_batches(rows: DataFrame, bins: Bins, chance: Column, count: int, by=()):
    """:func:`bag_trees` of rows that have their bins, ``_y`` and what ``chance`` reads."""
    done, step = 0, 1
    while done < count:
        trees = range(done, min(count, done + step))
        read = _reader(rows.sparkSession, count_bags(rows, bins, trees, chance, by))
        if step == 1 and count > 1:  # the first tree tells how many fit into a pass
            step = max(1, BAG_ROWS // max(1, read(done)[1]))
        yield trees, read
        done = trees[-1] + 1


def tune(train: DataFrame, bins: Bins, estimator, values: dict, label: str, key_cols, folds: int, fold_col: str) -> CountedModel:
    """Choose the cell of the grid with the least mean RMSE over the folds and fit it on all rows.

    ``train`` has its folds in ``fold_col``. Errors are those of the rows: their spread within a combination is added.
    Without ``values`` the estimator is fitted as it is.
    """
    from terrasift.operators.models import grid
    spark, by = train.sparkSession, [fold_col] if values else []
    counts = count_rows(train, bins, label, by)
    facts = counts.groupBy(*by).agg(F.sum(ROWS).alias("n"), F.count(F.lit(1)).alias("groups")).collect()
    size, groups = {r[fold_col] if by else 0: r["n"] for r in facts}, sum(r["groups"] for r in facts)
    total, maps = sum(size.values()), grid(estimator, values) or [{}]
    forest = isinstance(estimator, RandomForestRegressor) and estimator.getBootstrap()
    # Cells that differ only in the number of trees share the trees they have in common.
    kinds = {}
    for k, cell in enumerate(maps):
        number = cell.get(estimator.numTrees, estimator.getNumTrees()) if forest else 1
        rest = tuple(sorted(((p.name, v) for p, v in cell.items() if not (forest and p.name == "numTrees"))))
        kinds.setdefault(rest, []).append((k, number, {p: v for p, v in cell.items() if not (forest and p.name == "numTrees")}))
    parts = [None] if not values else range(folds)

    def outside(df, fold):
        return df if fold is None else df.filter(F.col(fold_col) != fold)

    def weight(fold):
        return total - (size.get(fold, 0) if fold is not None else 0)

    bagged = []

    def fitted(jobs) -> dict:
        """Models by (kind, fold) for jobs (kind, fold, number of trees)."""
        found = {(kind, fold): [None] * number for kind, fold, number in jobs}
        if not forest:
            whole = fit_rows(bins, counts, groups).persist()
            try:
                def one(job):
                    kind, fold, _ = job
                    found[kind, fold][0] = _ready(estimator, weight(fold), extra=kinds[kind][0][2]).fit(outside(whole, fold))
                _side_by_side(spark, one, jobs)
            finally:
                whole.unpersist()
            return found
        seed = estimator.getSeed()
        if not bagged:
            bagged.append(bag_rows(train, bins, label, key_cols, seed, groups, by))
        for trees, read in bag_trees(bagged[0], bins, groups, max(n for *_, n in jobs), by):
            parts_of = dict(zip(trees, _side_by_side(spark, read, trees)))

            def one(job):
                kind, fold, tree = job
                part, rows = parts_of[tree]
                params = one_tree(estimator, tree, seed) | kinds[kind][0][2]
                found[kind, fold][tree] = _ready(estimator, weight(fold), extra=params).fit(fit_rows(bins, outside(part, fold), rows, TREE_ROWS))
            _side_by_side(spark, one, [(kind, fold, t) for t in trees for kind, fold, number in jobs if t < number])
        return found

    errors = [[] for _ in maps]
    if values:
        jobs = [(kind, fold, max(n for _, n, _ in cells)) for kind, cells in kinds.items() for fold in parts]
        models = fitted(jobs)

        def error(job):
            kind, fold, _ = job
            numbers = sorted({n for _, n, _ in kinds[kind]})
            held = CountedModel(bins, models[kind, fold], {}).scored(counts.filter(F.col(fold_col) == fold), many=numbers)
            return held.agg(*[F.sqrt(F.sum(F.col(SPREAD) + F.col(ROWS) * F.pow(F.col(MEAN) - F.col(f"_first{n}"), 2)) / F.sum(ROWS)).alias(str(n))
                              for n in numbers]).first()
        for (kind, _, _), row in zip(jobs, _side_by_side(spark, error, jobs)):
            for k, n, _ in kinds[kind]:
                errors[k].append(math.nan if row[str(n)] is None else row[str(n)])
    means = [sum(e) / len(e) if e else math.nan for e in errors]
    best = min(range(len(maps)), key=lambda k: (math.isnan(means[k]), means[k], k)) if values else 0
    kind, number = next((kind, n) for kind, cells in kinds.items() for k, n, _ in cells if k == best)
    final = fitted([(kind, None, number)])[kind, None]
    return CountedModel(bins, final, {p.name: v for p, v in maps[best].items()}, means)


def tree_on_values(found: CountedModel, estimator):
    """The only tree of ``found`` as a fit of ``estimator`` on the rows would return it: it splits values, not bins."""
    jvm, root = SparkSession.active()._jvm.org.apache.spark.ml, found.models[0]._java_obj.rootNode()

    def node(at):
        if at.getClass().getSimpleName() == "LeafNode":
            return at
        split = at.split()
        k, threshold = split.featureIndex(), split.threshold()
        cuts = found.bins.cuts.get(found.bins.names[k])
        if cuts:  # bins up to the threshold hold what is below the cut after them
            threshold = math.nextafter(cuts[math.floor(threshold)], -math.inf)
        return jvm.tree.InternalNode(at.prediction(), at.impurity(), at.gain(), node(at.leftChild()), node(at.rightChild()),
                                     jvm.tree.ContinuousSplit(k, threshold), at.impurityStats())
    model = DecisionTreeRegressionModel(jvm.regression.DecisionTreeRegressionModel(estimator.uid, node(root), found.bins.width))
    return estimator._copyValues(model)
