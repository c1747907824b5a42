"""Regression and classification measures."""

from pyspark.sql import functions as F

from terrasift.functions import labels, vectors
from terrasift.functions.numeric import within
from terrasift.operators import classify
from terrasift.operators import metrics as ops
from terrasift.plans.catalog import query, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
ABSENT = "never_seen"

RULE_SQL = """(SELECT event_id, event_type AS t, CASE WHEN value > 20 THEN 'view' WHEN value < 5 THEN 'Unknown'
 ELSE event_type END AS p, CASE WHEN user_id = 8 THEN 'Unknown' ELSE event_type END AS known FROM events)"""


def _ruled(spark, folder):
    predicted = (F.when(F.col("value") > 20, "view").when(F.col("value") < 5, "Unknown").otherwise(F.col("event_type")))
    return table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("t"), predicted.alias("p"),
        F.when(F.col("user_id") == 8, "Unknown").otherwise(F.col("event_type")).alias("known"))


PRICE_SQL = ("(SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 AS y, CASE WHEN l_discount = 0 THEN NULL "
             "ELSE l_quantity * 0.15::DOUBLE END AS p FROM lineitem)")


def _priced(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 10000).alias("y"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity") * 0.15).alias("p"))


@query("rmse", f"SELECT round(sqrt(avg((y-p)*(y-p))), 6) AS rmse FROM {PRICE_SQL}")
def rmse(spark, folder):
    return ops.rmse(_priced(spark, folder), "y", "p").select(F.round("rmse", 6).alias("rmse"))


@query("within_threshold", f"""
SELECT count(*) FILTER (WHERE y - p BETWEEN -0.5 AND 0.5) AS correct, count(p) AS total,
 round(coalesce(count(*) FILTER (WHERE y - p BETWEEN -0.5 AND 0.5) / nullif(count(p), 0)::DOUBLE, 0), 8) AS accuracy FROM {PRICE_SQL}""")
def within_threshold(spark, folder):
    return ops.within_threshold(_priced(spark, folder), "y", "p").withColumn("accuracy", F.round("accuracy", 8))


@query("range_predicate", f"SELECT l_orderkey, l_linenumber, (y - p BETWEEN -0.5 AND 0.5) AS close FROM {PRICE_SQL}")
def range_predicate(spark, folder):
    return _priced(spark, folder).select("l_orderkey", "l_linenumber", within(F.col("y"), F.col("p"), 0.5).alias("close"))


@query("regression_report", f"""
SELECT round(sqrt(avg((y-p)*(y-p))), 6) AS rmse, count(*) AS rows, count(y - p) AS usable,
 round(count(*) FILTER (WHERE abs(y - p) <= 0.5) / nullif(count(p), 0)::DOUBLE, 8) AS accuracy FROM {PRICE_SQL}""")
def regression_report(spark, folder):
    out = ops.regression_report(_priced(spark, folder), "y", "p")
    return out.withColumns({"rmse": F.round("rmse", 6), "accuracy": F.round("accuracy", 8)})


@query("accuracy", f"""
SELECT count(*) FILTER (WHERE t = p) AS correct, count(*) AS total,
 round(count(*) FILTER (WHERE t = p) / count(*)::DOUBLE, 8) AS accuracy FROM {RULE_SQL}""")
def accuracy(spark, folder):
    return ops.accuracy(_ruled(spark, folder), "t", "p").withColumn("accuracy", F.round("accuracy", 8))


@query("accuracy_known", f"""
SELECT round(100 * avg((known = p)::INT) FILTER (WHERE known <> 'Unknown'), 6) AS accuracy_pct,
 count(*) FILTER (WHERE known <> 'Unknown') AS known FROM {RULE_SQL}""")
def accuracy_known(spark, folder):
    out = ops.accuracy_known(_ruled(spark, folder), "known", "p")
    return out.withColumn("accuracy_pct", F.round("accuracy_pct", 6))


@query("known_labels_only", f"SELECT event_id, known FROM {RULE_SQL} WHERE known <> 'Unknown'")
def known_labels_only(spark, folder):
    return _ruled(spark, folder).filter(F.col("known") != "Unknown").select("event_id", "known")


@query("misclassified", f"SELECT event_id, t, p FROM {RULE_SQL} WHERE t <> p")
def misclassified(spark, folder):
    return ops.misclassified(_ruled(spark, folder).select("event_id", "t", "p"), "t", "p")


@query("misclassified_once", """
SELECT 'u/' || user_id AS path, min(event_id) AS event_id, arg_min(event_type, event_id) AS t, 'view' AS p
FROM events WHERE value > 20 AND event_type <> 'view' GROUP BY user_id""")
def misclassified_once(spark, folder):
    """A path met several times is reported once, with its first row."""
    rows = table(spark, folder, "events").select(
        F.concat(F.lit("u/"), F.col("user_id").cast("string")).alias("path"), "event_id",
        F.col("event_type").alias("t"), F.when(F.col("value") > 20, "view").otherwise(F.col("event_type")).alias("p"))
    return ops.misclassified(rows, "t", "p", "path")


@query("misclassified_last_epoch", """
SELECT event_id, event_type AS t, 'view' AS p, month(ts) AS epoch FROM events
WHERE value > 20 AND event_type <> 'view' AND month(ts) = (SELECT max(month(ts)) FROM events)""")
def misclassified_last_epoch(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("t"), F.when(F.col("value") > 20, "view").otherwise(F.col("event_type")).alias("p"),
        F.month("ts").cast("bigint").alias("epoch"))
    return ops.misclassified(rows, "t", "p", epoch="epoch")


GRID = f"""
WITH r AS (SELECT t, p FROM {RULE_SQL}),
l AS (SELECT t AS label FROM r UNION SELECT p FROM r UNION SELECT '{ABSENT}' UNION SELECT unnest({EVENT_TYPES})),
i AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS k FROM l),
g AS (SELECT p.k AS x, t.k AS y, t.label AS true_label, p.label AS predicted,
 (SELECT count(*) FROM r WHERE r.t = t.label AND r.p = p.label) AS n FROM i t, i p)
"""


@query("confusion_matrix", GRID + "SELECT true_label, predicted, n FROM g")
def confusion_matrix(spark, folder):
    return ops.confusion_matrix(_ruled(spark, folder), "t", "p", EVENT_TYPES + [ABSENT])


@query("heatmap_triples", GRID + "SELECT x, y, true_label, predicted, n FROM g")
def heatmap_triples(spark, folder):
    return ops.heatmap_triples(_ruled(spark, folder), "t", "p", EVENT_TYPES + [ABSENT])


@query("label_universe", GRID + "SELECT label FROM i")
def label_universe(spark, folder):
    return ops.label_universe(_ruled(spark, folder), "t", "p", EVENT_TYPES + [ABSENT])


@query("colour_maximum", f"SELECT max(n) AS max_cell FROM (SELECT count(*) AS n FROM {RULE_SQL} GROUP BY t, p)")
def colour_maximum(spark, folder):
    return ops.colour_maximum(_ruled(spark, folder), "t", "p")


@query("heatmap_cells", GRID + "SELECT x, y, true_label, predicted, n FROM g WHERE n > 0")
def heatmap_cells(spark, folder):
    return ops.heatmap_cells(_ruled(spark, folder), "t", "p", EVENT_TYPES + [ABSENT])


@query("confusion_pivot", GRID + "SELECT label AS true_label, " + ", ".join(
    f"(SELECT count(*) FROM r WHERE r.t = label AND r.p = '{c}') AS \"{c}\"" for c in [*EVENT_TYPES, "Unknown", ABSENT]) + " FROM i")
def confusion_pivot(spark, folder):
    return ops.confusion_pivot(_ruled(spark, folder), "t", "p", [ABSENT])


@query("confusion_pivot_total", f"SELECT count(*) AS rows FROM {RULE_SQL}")
def confusion_pivot_total(spark, folder):
    """The cells of the square add up to the rows."""
    square = confusion_pivot(spark, folder)
    cells = sum((F.col(f"`{c}`") for c in square.columns if c != "true_label"), F.lit(0))
    return square.agg(F.sum(cells).cast("bigint").alias("rows"))


SOFTMAX_SQL = """(SELECT vec_id, label, i, x, exp(x - m) / sum(exp(x - m)) OVER w AS p FROM
 (SELECT *, max(x) OVER (PARTITION BY vec_id) AS m FROM
  (SELECT vec_id, label, (j - 1) // 16 + 1 AS i, sum(embedding[j]::DOUBLE) AS x
   FROM embeddings, (SELECT unnest(range(1, 65)) AS j) GROUP BY ALL)) WINDOW w AS (PARTITION BY vec_id))"""


def _four_scores(spark, folder):
    """Four scores from all 64 values, each the sum of a quarter."""
    values = F.col("embedding").cast("array<double>")
    sums = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.aggregate(
        F.slice(values, k * 16 + 1, 16), F.lit(0.0), lambda acc, x: acc + x))
    return table(spark, folder, "embeddings").select("vec_id", (F.col("label") % 4).alias("label"), sums.alias("scores"))


NAMES_SQL = "list_extract(['Cyclone','Earthquake','Flood','Wildfire'], {0})"


@query("top_class", f"""
SELECT vec_id, CAST(arg_max(i, x) - 1 AS INTEGER) AS class_id, {NAMES_SQL.format('arg_max(i, x)')} AS predicted,
 round(max(p), 6) AS confidence FROM {SOFTMAX_SQL} GROUP BY vec_id""")
def top_class(spark, folder):
    out = classify.top_class(_four_scores(spark, folder), "scores", keep=["vec_id"])
    return out.select("vec_id", "class_id", "predicted", F.round("confidence", 6).alias("confidence"))


@query("log_loss", f"SELECT round(avg(-ln(p)), 6) AS log_loss FROM {SOFTMAX_SQL} WHERE i = label % 4 + 1")
def log_loss(spark, folder):
    probable = _four_scores(spark, folder).select("label", vectors.softmax(F.col("scores")).alias("probabilities"))
    return ops.log_loss(probable, "label", "probabilities").select(F.round("log_loss", 6).alias("log_loss"))


@query("batch_mean_loss", f"""
SELECT round(avg(l), 6) AS mean_loss FROM
 (SELECT vec_id // 64 AS b, avg(-ln(p)) AS l FROM {SOFTMAX_SQL} WHERE i = label % 4 + 1 GROUP BY b)""")
def batch_mean_loss(spark, folder):
    probable = _four_scores(spark, folder).select(
        "label", vectors.softmax(F.col("scores")).alias("probabilities"), F.floor(F.col("vec_id") / 64).alias("batch"))
    return ops.batch_mean_loss(probable, "label", "probabilities", "batch").select(F.round("mean_loss", 6).alias("mean_loss"))


@query("class_names", """
SELECT vec_id, CASE label WHEN 0 THEN 'Cyclone' WHEN 1 THEN 'Earthquake' WHEN 2 THEN 'Flood' WHEN 3 THEN 'Wildfire'
 ELSE '未知(' || label || ')' END AS name FROM embeddings""")
def class_names(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", labels.class_name(F.col("label")).alias("name"))


@query("infer_label_substring", """
SELECT page_id, CASE WHEN contains(lower(url), 'en') THEN 'EN' WHEN contains(lower(url), 'fr') THEN 'Fr'
 WHEN contains(lower(url), 'wiki') THEN 'wiki' ELSE 'Unknown' END AS label FROM pages""")
def infer_label_substring(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", labels.label_from_path(F.col("url"), ["EN", "Fr", "wiki"], "substring").alias("label"))


@query("infer_label_directory", """
SELECT page_id, CASE list_extract(string_split(lower(url), '/'), -2) WHEN 'en' THEN 'EN' WHEN 'fr' THEN 'Fr'
 WHEN 'de' THEN 'de' ELSE 'Unknown' END AS label FROM pages""")
def infer_label_directory(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", labels.label_from_path(F.col("url"), ["EN", "Fr", "de"]).alias("label"))
