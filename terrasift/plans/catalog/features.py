"""Scaling, normalisation and PCA."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from terrasift.functions.vectors import vector_to_array
from terrasift.operators import features as ops
from terrasift.operators import quality
from terrasift.plans.catalog import query, table

MEASURES = ["l_quantity", "l_discount", "l_tax"]


def _with_gaps(spark, folder):
    """Line items whose zero discounts count as missing."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax")


def _rounded(df, keep, digits=6):
    return df.select(*keep, *[F.round(c, digits).alias(c) for c in df.columns if c not in keep])


@query("feature_minmax_l2", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity q, l_discount d, l_tax t FROM lineitem WHERE l_discount <> 0),
r AS (SELECT min(q) q0, max(q) q1, min(d) d0, max(d) d1, min(t) t0, max(t) t1 FROM c),
s AS (SELECT l_orderkey, l_linenumber, (q-q0)/(q1-q0) q, (d-d0)/(d1-d0) d, (t-t0)/(t1-t0) t FROM c, r),
n AS (SELECT *, sqrt(q*q+d*d+t*t) m FROM s)
SELECT l_orderkey, l_linenumber,
 round(q,6) AS "MinMaxScaler_l_quantity", round(d,6) AS "MinMaxScaler_l_discount", round(t,6) AS "MinMaxScaler_l_tax",
 round(CASE WHEN m=0 THEN 0 ELSE q/m END,6) AS "normalized_l_quantity",
 round(CASE WHEN m=0 THEN 0 ELSE d/m END,6) AS "normalized_l_discount",
 round(CASE WHEN m=0 THEN 0 ELSE t/m END,6) AS "normalized_l_tax" FROM n""")
def feature_minmax_l2(spark, folder):
    keys = ["l_orderkey", "l_linenumber"]
    return _rounded(ops.feature_table(_with_gaps(spark, folder), MEASURES, keep=keys), keys)


@query("feature_minmax", """
SELECT o_orderkey, round((o_totalprice - lo)/(hi - lo), 6) AS "MinMaxScaler_o_totalprice"
FROM orders, (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders)""")
def feature_minmax(spark, folder):
    out = ops.scaled_table(table(spark, folder, "orders"), ["o_totalprice"], keep=["o_orderkey"], normalize=False)
    return _rounded(out, ["o_orderkey"])


@query("vector_keep_scale_normalize", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity q, nullif(l_discount, 0) d, l_tax t FROM lineitem),
r AS (SELECT min(q) q0, max(q) q1, min(d) d0, max(d) d1, min(t) t0, max(t) t1 FROM c),
s AS (SELECT l_orderkey, l_linenumber, (q-q0)/(q1-q0) q, (d-d0)/(d1-d0) d, (t-t0)/(t1-t0) t FROM c, r),
n AS (SELECT *, sqrt(q*q+d*d+t*t) m FROM s)
SELECT l_orderkey, l_linenumber, round(d,6) AS scaled_discount,
 round(CASE WHEN m=0 THEN 0 ELSE q/m END,6) AS normal_quantity,
 round(CASE WHEN m=0 THEN 0 ELSE d/m END,6) AS normal_discount FROM n""")
def vector_keep_scale_normalize(spark, folder):
    df = _with_gaps(spark, folder)
    stages = ops.feature_stages(MEASURES, invalid="keep")
    out = Pipeline(stages=stages).fit(df).transform(df)
    scaled, normal = vector_to_array(F.col("scaled")), vector_to_array(F.col("features"))

    def shown(x):
        return F.round(F.when(~F.isnan(x), x), 6)
    return out.select("l_orderkey", "l_linenumber", shown(scaled[1]).alias("scaled_discount"),
                      shown(normal[0]).alias("normal_quantity"), shown(normal[1]).alias("normal_discount"))


@query("vector_columns", """
SELECT l_orderkey, l_linenumber, l_quantity AS raw_l_quantity, l_tax AS raw_l_tax FROM lineitem""")
def vector_columns(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    names = ["l_quantity", "l_tax"]
    out = ops.expand_vector(ops.assemble(df, names, "v"), "v", names, "raw_")
    return quality.reshape_columns(out, drop=names)


@query("assemble_skip_count", """
SELECT count(*) FILTER (WHERE l_discount <> 0) AS rows_kept, count(*) FILTER (WHERE l_discount = 0) AS rows_skipped
FROM lineitem""")
def assemble_skip_count(spark, folder):
    return ops.skip_accounting(_with_gaps(spark, folder), MEASURES)


@query("assemble_skip", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem WHERE l_discount <> 0""")
def assemble_skip(spark, folder):
    out = ops.assemble(_with_gaps(spark, folder), MEASURES, "v", invalid="skip")
    parts = vector_to_array(F.col("v"))
    return out.select("l_orderkey", "l_linenumber", *[parts[i].alias(c) for i, c in enumerate(MEASURES)])


PRINCIPAL = """
WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity a, l_discount * 100 b FROM lineitem),
m AS (SELECT var_samp(a) va, var_samp(b) vb, covar_samp(a, b) c FROM x),
e AS (SELECT *, (va+vb)/2 + sqrt(((va-vb)/2)*((va-vb)/2) + c*c) l1, (va+vb)/2 - sqrt(((va-vb)/2)*((va-vb)/2) + c*c) l2 FROM m),
v AS (SELECT *, c/sqrt(c*c + (l1-va)*(l1-va)) u, (l1-va)/sqrt(c*c + (l1-va)*(l1-va)) w FROM e)
"""


def _pair(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"))


@query("pca_project", PRINCIPAL + """
SELECT l_orderkey, l_linenumber, round(abs(a*u + b*w), 6) AS pc1, round(abs(-a*w + b*u), 6) AS pc2 FROM x, v""")
def pca_project(spark, folder):
    """Two features, where the components have a closed form; their sign is free."""
    out = ops.pca_project(_pair(spark, folder), ["a", "b"], 2, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.abs(c), 6).alias(c) for c in ("pc1", "pc2")])


@query("pca_variance", PRINCIPAL + """
SELECT 1 AS component, round(l1/(l1+l2), 6) AS ratio FROM v
UNION ALL SELECT 2, round(l2/(l1+l2), 6) FROM v""")
def pca_variance(spark, folder):
    return ops.explained_variance(_pair(spark, folder), ["a", "b"], 0).withColumn("ratio", F.round("ratio", 6))


@query("pca_all_measures")
def pca_all_measures(spark, folder):
    df = table(spark, folder, "lineitem")
    return ops.pca_project(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 3,
                           keep=["l_orderkey", "l_linenumber"])
