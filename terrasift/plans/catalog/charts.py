"""Aggregates behind charts."""

from pyspark.sql import functions as F

from terrasift.operators import charts as ops
from terrasift.operators import models
from terrasift.operators.features import assemble
from terrasift.plans.catalog import query, table
from terrasift.plans.catalog.models import MEASURES, TWO_LEVELS, two_level_tree


@query("chart_histogram", """
WITH e AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi FROM lineitem),
c AS (SELECT least(19, CAST(floor((l_extendedprice - lo) / (hi - lo) * 20) AS BIGINT)) AS bin, count(*) n FROM lineitem, e GROUP BY 1)
SELECT CAST(b AS BIGINT) AS bin, round(lo + b * (hi - lo) / 20, 6) AS lower, round(lo + (b + 1) * (hi - lo) / 20, 6) AS upper,
 coalesce(n, 0) AS n FROM range(20) r(b), e LEFT JOIN c ON c.bin = b""")
def chart_histogram(spark, folder):
    out = ops.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 20)
    return out.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query("chart_box", """
WITH q AS (SELECT event_type, count(value) n, min(value) lo, max(value) hi, quantile_cont(value, 0.25) q1,
 quantile_cont(value, 0.5) m, quantile_cont(value, 0.75) q3 FROM events GROUP BY event_type)
SELECT q.event_type, q.n, q.lo AS "min", q.hi AS "max", round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
 min(value) FILTER (WHERE value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_low,
 max(value) FILTER (WHERE value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_high,
 count(*) FILTER (WHERE value NOT BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS outliers
FROM events e JOIN q ON e.event_type = q.event_type GROUP BY q.event_type, q.n, q.lo, q.hi, q1, m, q3""")
def chart_box(spark, folder):
    out = ops.box_stats(table(spark, folder, "events"), "value", "event_type")
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("chart_line", """
SELECT date_trunc('month', l_shipdate) AS period, count(*) AS n, round(sum(l_quantity), 4) AS total,
 round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1""")
def chart_line(spark, folder):
    out = ops.line(table(spark, folder, "lineitem"), "l_shipdate", "l_quantity")
    return out.withColumns({"total": F.round("total", 4), "mean": F.round("mean", 6),
                            "period": F.col("period").cast("timestamp_ntz")})


@query("chart_bar", "SELECT l_returnflag AS category, count(*) AS n FROM lineitem GROUP BY 1")
def chart_bar(spark, folder):
    return ops.bar(table(spark, folder, "lineitem"), "l_returnflag")


@query("chart_scatter", "SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem")
def chart_scatter(spark, folder):
    return ops.scatter(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")


@query("chart_scatter_sample", """
SELECT o_orderkey AS x, o_totalprice AS y FROM orders
WHERE CAST(('0x' || substr(md5('0|' || length(o_orderkey::VARCHAR) || ':' || o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.05::DOUBLE""")
def chart_scatter_sample(spark, folder):
    return ops.scatter(table(spark, folder, "orders"), "o_orderkey", "o_totalprice", ["o_orderkey"], share=0.05)


CURVE = """
WITH s AS (SELECT n_chars AS score, quality AS y FROM labels JOIN documents USING (doc_id)),
c AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY score),
r AS (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
 sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM c WINDOW w AS (ORDER BY score DESC))
"""


def _curve(spark, folder):
    scored = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    return ops.roc_points(scored, "n_chars", "quality")


@query("roc_points", CURVE + """
SELECT score, pos, neg, tp, fp, round(tp / ap::DOUBLE, 8) AS tpr, round(fp / an::DOUBLE, 8) AS fpr FROM r""")
def roc_points(spark, folder):
    return _curve(spark, folder).withColumns({"tpr": F.round("tpr", 8), "fpr": F.round("fpr", 8)})


@query("roc_auc", """
WITH s AS (SELECT n_chars AS score, quality AS y FROM labels JOIN documents USING (doc_id)),
p AS (SELECT score, count(*) AS n FROM s WHERE y = 1 GROUP BY score), q AS (SELECT score, count(*) AS n FROM s WHERE y <> 1 GROUP BY score)
SELECT round(sum(p.n * q.n * CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END)
 / (SELECT (sum(p.n)) FROM p) / (SELECT sum(q.n) FROM q), 8)::DOUBLE AS auc FROM p, q""")
def roc_auc(spark, folder):
    return ops.roc_auc(_curve(spark, folder)).select(F.round("auc", 8).alias("auc"))


OLS = "(SELECT regr_slope(l_extendedprice, l_quantity) b, regr_intercept(l_extendedprice, l_quantity) a FROM lineitem)"


def _fitted(spark, folder):
    df = assemble(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"),
                  ["l_quantity"], "features")
    return models.linear("l_extendedprice", regParam=0.0, solver="normal").fit(df).transform(df)


@query("residuals", f"""
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS predicted,
 round(l_extendedprice - (a + b * l_quantity), 3) AS residual FROM lineitem, {OLS}""")
def residuals(spark, folder):
    out = ops.residuals(_fitted(spark, folder), "l_extendedprice", keep=["l_orderkey", "l_linenumber"])
    return out.withColumns({c: F.round(c, 3) for c in ("predicted", "residual")})


@query("pred_vs_actual", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, round(a + b * l_quantity, 3) AS predicted FROM lineitem, {OLS}""")
def pred_vs_actual(spark, folder):
    out = ops.predicted_vs_actual(_fitted(spark, folder), "l_extendedprice", keep=["l_orderkey", "l_linenumber"])
    return out.withColumn("predicted", F.round("predicted", 3))


SIDE_SQL = "SELECT CAST({line} AS INTEGER) AS line, CAST({depth} AS INTEGER) AS depth, {kind} AS kind, {rest}"


def _rule_lines():
    """The printed order of a full two-level tree: 10 lines around 3 splits and 4 leaves."""
    split = "f AS feature, round(cut, 6) AS threshold, CAST(NULL AS DOUBLE) AS prediction FROM picks WHERE node = {0}"
    leaf = "CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), round({1}, 6) FROM picks WHERE node = {0}"
    plan = [(0, "'if'", split.format(1)), (1, "'if'", split.format(2)), (2, "'leaf'", leaf.format(2, "lo")),
            (1, "'else'", split.format(2)), (2, "'leaf'", leaf.format(2, "hi")), (0, "'else'", split.format(1)),
            (1, "'if'", split.format(3)), (2, "'leaf'", leaf.format(3, "lo")), (1, "'else'", split.format(3)),
            (2, "'leaf'", leaf.format(3, "hi"))]
    return " UNION ALL ".join(SIDE_SQL.format(line=i, depth=d, kind=k, rest=r) for i, (d, k, r) in enumerate(plan))


@query("tree_rules", TWO_LEVELS + _rule_lines())
def tree_rules(spark, folder):
    model, _ = two_level_tree(spark, folder)
    out = ops.tree_rules(spark, model, MEASURES)
    return out.withColumns({c: F.round(c, 6) for c in ("threshold", "prediction")})


@query("feature_importance", TWO_LEVELS + """
SELECT n.f AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM picks), 6) AS importance
FROM (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS f) n LEFT JOIN picks USING (f) GROUP BY n.f""")
def feature_importance(spark, folder):
    model, _ = two_level_tree(spark, folder)
    return ops.feature_importance(spark, model, MEASURES).withColumn("importance", F.round("importance", 6))
