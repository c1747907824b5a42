"""Training aids: fold sums, bags by hash, boosting losses, resumable comparison."""

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from terrasift.operators import bagging, boosting, features, fold_sums, work
from terrasift.operators import models as ops
from terrasift.plans.catalog import query, table
from terrasift.plans.catalog.models import FOLD, KEYS, LABEL, MEASURES, STUMP, _items, _one_feature
from terrasift.session import scratch_path

KEY_TEXT = "'|' || " + " || '|' || ".join(f"length({k}::VARCHAR) || ':' || {k}" for k in KEYS)


def _draw(seed: str) -> str:
    return f"CAST(('0x' || substr(md5({seed} || {KEY_TEXT}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


RIDGE_CELLS = f"""
WITH d AS (SELECT l_quantity::DOUBLE a, l_discount::DOUBLE b, l_tax::DOUBLE c, (l_extendedprice / 10000)::DOUBLE y, {FOLD} f FROM lineitem),
m AS (SELECT g.f, avg(a) ma, avg(b) mb, avg(c) mc, avg(y) my, stddev_pop(a) sa, stddev_pop(b) sb, stddev_pop(c) sc, stddev_pop(y) sy,
 corr(a, b) ab, corr(a, c) ac, corr(b, c) bc, corr(a, y) ay, corr(b, y) by_, corr(c, y) cy
 FROM (SELECT unnest([0, 1, 2]) f) g JOIN d ON d.f <> g.f GROUP BY g.f),
k AS (SELECT *, 1 + lam / sy AS t FROM m, (SELECT unnest([0.01::DOUBLE, 0.1::DOUBLE]) AS lam)),
n AS (SELECT *, t * (t * t - bc * bc) - ab * (ab * t - bc * ac) + ac * (ab * bc - t * ac) AS det FROM k),
w AS (SELECT f, lam, ma, mb, mc, my,
 (ay * (t * t - bc * bc) - ab * (by_ * t - bc * cy) + ac * (by_ * bc - t * cy)) / det * sy / sa AS wa,
 (t * (by_ * t - bc * cy) - ay * (ab * t - bc * ac) + ac * (ab * cy - by_ * ac)) / det * sy / sb AS wb,
 (t * (t * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - t * ac)) / det * sy / sc AS wc FROM n),
e AS (SELECT w.f, lam, sqrt(avg(power(y - my - wa * (a - ma) - wb * (b - mb) - wc * (c - mc), 2))) AS e FROM w JOIN d ON d.f = w.f GROUP BY ALL),
r AS (SELECT lam, avg(e) AS e FROM e GROUP BY lam)
SELECT 'elasticNetParam=0.0, regParam=' || lam AS params, round(e, 6) AS rmse, e = min(e) OVER () AS best FROM r"""


@query("cv_grid_ridge", RIDGE_CELLS)
def cv_grid_ridge(spark, folder):
    """The ridge cells of the linear grid over three features and three folds, from one aggregate."""
    found = fold_sums.linear_grid(_items(spark, folder), MEASURES, LABEL, KEYS, {"regParam": [0.01, 0.1], "elasticNetParam": [0.0]})
    return found.select("params", F.round("rmse", 6).alias("rmse"), "best")


@query("cv_grid_one_pass")
def cv_grid_one_pass(spark, folder):
    """All cells of the linear grid, elastic net included."""
    return fold_sums.linear_grid(_items(spark, folder), MEASURES, LABEL, KEYS)


TREES = 5
BAGS = " UNION ALL ".join(f"SELECT {t} AS t, l_orderkey, l_linenumber, l_quantity::DOUBLE q, (l_extendedprice / 10000)::DOUBLE y, {_draw(repr(f'42.{t}'))} AS u FROM lineitem"
                          for t in range(TREES))
WEIGHT = " + ".join(f"(u >= {p!r}::DOUBLE)::INTEGER" for p in bagging.POISSON)


@query("rf_hash_bagging", f"""
WITH bags AS ({BAGS}), b AS (SELECT t, q, y, {WEIGHT} AS w FROM bags),
c AS (SELECT t, q, sum(w) n, sum(w * y) s FROM b WHERE w > 0 GROUP BY t, q),
e AS (SELECT t, q, lead(q) OVER o nq, sum(n) OVER o ln, sum(s) OVER o ls, sum(n) OVER a tn, sum(s) OVER a ts FROM c
 WINDOW o AS (PARTITION BY t ORDER BY q), a AS (PARTITION BY t)),
s AS (SELECT t, (q + nq) / 2 cut, ls / ln lo, (ts - ls) / (tn - ln) hi FROM e WHERE nq IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY t ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC) = 1)
SELECT l_orderkey, l_linenumber, round(avg(CASE WHEN l_quantity <= cut THEN lo ELSE hi END), 6) AS prediction
FROM lineitem, s GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey""")
def rf_hash_bagging(spark, folder):
    """A bootstrap forest of depth 1: bags, splits and leaves as SQL finds them from the hashes of the rows."""
    df = _items(spark, folder)
    forest = bagging.fit_hashed_forest(df, ["l_quantity"], LABEL, KEYS, trees=TREES, bins=64, maxDepth=1)
    # As in the SQL, rows with equal keys are one row with the mean of their predictions.
    scored = forest.transform(df).groupBy(*KEYS).agg(F.round(F.avg("prediction"), 6).alias("prediction"))
    return scored.select("l_orderkey", "l_linenumber", "prediction")


@query("rf_hash_bagging_deep")
def rf_hash_bagging_deep(spark, folder):
    df = _items(spark, folder)
    forest = bagging.fit_hashed_forest(df, MEASURES, LABEL, KEYS, trees=20, maxDepth=5)
    return forest.transform(df).select("l_orderkey", "l_linenumber", LABEL, "prediction")


ROUNDS = 3


def _rounds_sql() -> str:
    steps, source = [], "d0"
    for k in range(1, ROUNDS + 1):
        steps.append(STUMP.format(name=f"s{k}", source=f"(SELECT q, r AS y FROM {source} WHERE NOT v)"))
        shrink = "1.0::DOUBLE" if k == 1 else "0.1::DOUBLE"
        steps.append(f"""
p{k} AS (SELECT q, y, v, p + {shrink} * CASE WHEN q <= cut THEN lo ELSE hi END AS p FROM {source}, s{k}),
d{k} AS (SELECT *, 2 * (y - p) AS r FROM p{k})""")
        source = f"d{k}"
    losses = " UNION ALL ".join(
        f"SELECT {k} AS round, avg(power(y - p, 2)) FILTER (NOT v) AS train_loss, avg(power(y - p, 2)) FILTER (v) AS validation_loss FROM d{k}"
        for k in range(1, ROUNDS + 1))
    return f"""
WITH d0 AS (SELECT l_quantity::DOUBLE q, (l_extendedprice / 10000)::DOUBLE y, 0.0::DOUBLE AS p, (l_extendedprice / 10000)::DOUBLE AS r,
 {_draw("'42'")} < 0.2::DOUBLE AS v FROM lineitem),
{", ".join(steps)},
l AS ({losses}),
g AS (SELECT *, lag(validation_loss) OVER (ORDER BY round) - validation_loss < 0.01::DOUBLE * greatest(validation_loss, 0.01::DOUBLE) AS poor FROM l)
SELECT round, round(train_loss, 6) AS train_loss, round(validation_loss, 6) AS validation_loss,
 coalesce(NOT bool_or(poor) OVER (ORDER BY round), true) AS kept FROM g"""


@query("gbt_loss_table", _rounds_sql())
def gbt_loss_table(spark, folder):
    """Losses of three boosting rounds of depth 1 on the rows that train and on those that validate."""
    marked = boosting.mark_validation(_one_feature(spark, folder), KEYS)
    train, validation = (marked.filter(F.col(boosting.VALIDATES) == flag) for flag in (False, True))
    model = ops.fit(ops.boosted_trees(LABEL, maxIter=ROUNDS, maxDepth=1, maxBins=64), train)
    found = boosting.loss_table(model, train, validation)
    return found.select("round", *[F.round(c, 6).alias(c) for c in ("train_loss", "validation_loss")], "kept")


@query("gbt_early_stop")
def gbt_early_stop(spark, folder):
    """Boosting over all measures that stops by its validation rows, with the losses of the rounds kept."""
    df = features.assemble(_items(spark, folder), MEASURES, "features")
    model = boosting.fit_until(df, LABEL, KEYS, maxDepth=5)
    marked = boosting.mark_validation(df, KEYS)
    return boosting.loss_table(model, marked.filter(f"NOT {boosting.VALIDATES}"), marked.filter(boosting.VALIDATES))


@query("classifier_first_objective", """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT 0 AS iteration, round(-sum(n * ln((n + 1) / (total + classes))) / any_value(total), 6) AS objective
FROM c, (SELECT sum(n)::DOUBLE AS total, count(*)::DOUBLE AS classes FROM c)""")
def classifier_first_objective(spark, folder):
    """Where the objective of a multinomial classifier starts: at the entropy of the smoothed class shares."""
    df = table(spark, folder, "embeddings")
    df = features.assemble(df.select("label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)]), [f"e{i}" for i in range(64)], "features")
    model = LogisticRegression(labelCol="label", maxIter=3).fit(df)
    return boosting.objective_history(model).filter("iteration = 0").select("iteration", F.round("objective", 6).alias("objective"))


@query("resumable_comparison", f"""
WITH d AS (SELECT l_quantity x, l_extendedprice / 10000 y, {FOLD} f FROM lineitem),
m AS (SELECT g.f, avg(x) mx, avg(y) my, stddev_samp(x) sx, stddev_samp(y) sy, corr(x, y) r
 FROM (SELECT unnest([0, 1, 2]) f) g JOIN d ON d.f <> g.f GROUP BY g.f),
c AS (SELECT f, cell, lam, mx, my, r * sy / sx / (1 + lam / sy) b FROM m, (SELECT unnest([0, 1, 2]) cell, unnest([0.01::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE]) lam))
SELECT 'ridge' AS model, cell, 'regParam=' || lam AS params, c.f AS fold,
 round(sqrt(avg((y - (my + b * (x - mx))) * (y - (my + b * (x - mx))))), 5) AS rmse, 0 AS refitted FROM c JOIN d ON d.f = c.f GROUP BY ALL""")
def resumable_comparison(spark, folder):
    """The units of work of a comparison and their errors; a second run in the same folder has nothing to fit."""
    df, place = _one_feature(spark, folder), scratch_path(spark, "comparison")
    entries = {"ridge": (ops.linear(LABEL, solver="normal"), {"regParam": [0.01, 0.1, 1.0]})}
    work.compare(df, df, entries, LABEL, KEYS, place)
    _, again = work.compare(df, df, entries, LABEL, KEYS, place)
    units = work.finished(spark, place).filter(F.col("fold") != work.FINAL)
    return units.select("model", "cell", "params", "fold", F.round("rmse", 5).alias("rmse"), F.lit(len(again)).alias("refitted"))
