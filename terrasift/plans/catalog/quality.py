"""Profiles, casts, missing values, projections."""

from pyspark.sql import functions as F

from terrasift.operators import quality as ops
from terrasift.plans.catalog import query, table


@query("schema_overview", """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column",
 CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type
FROM (SELECT DISTINCT ordinal_position, column_name, data_type FROM information_schema.columns WHERE table_name = 'orders')""")
def schema_overview(spark, folder):
    return ops.schema_overview(table(spark, folder, "orders"))


def _numeric_sql(source, column):
    return (f"SELECT '{column}' AS \"column\", count({column}) AS \"count\", round(avg({column}),4) AS mean, "
            f"round(stddev_samp({column}),4) AS stddev, CAST(min({column}) AS DOUBLE) AS \"min\", "
            f"CAST(max({column}) AS DOUBLE) AS \"max\", CAST(NULL AS VARCHAR) AS min_text, "
            f"CAST(NULL AS VARCHAR) AS max_text FROM {source}")


def _text_sql(source, column):
    return (f"SELECT '{column}', count({column}), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
            f"CAST(NULL AS DOUBLE), min({column}), max({column}) FROM {source}")


@query("summary_stats", " UNION ALL ".join(
    [_numeric_sql("lineitem", c) for c in
     ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    + [_text_sql("lineitem", c) for c in ("l_returnflag", "l_linestatus")]))
def summary_stats(spark, folder):
    out = ops.summary(table(spark, folder, "lineitem"))
    return out.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("null_profile", """
SELECT count(*) FILTER (WHERE TRY_CAST(p_brand AS DOUBLE) IS NULL) AS "sum(p_brand)",
 count(*) FILTER (WHERE p_size = 11) AS "sum(p_size)", CAST(0 AS BIGINT) AS "sum(p_name)" FROM part""")
def null_profile(spark, folder):
    part = table(spark, folder, "part")
    return ops.null_profile(part.select(F.col("p_brand").try_cast("double").alias("p_brand"),
                                        F.nullif("p_size", F.lit(11)).alias("p_size"), "p_name"))


@query("missing_profile", """
SELECT 'value' AS "column", count(*) FILTER (WHERE event_type = 'error') AS nulls,
 count(*) FILTER (WHERE event_type IN ('error', 'click')) AS missing FROM events
UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id = 8), count(*) FILTER (WHERE user_id = 8) FROM events
UNION ALL SELECT 'props', 0, 0 FROM (SELECT count(*) FROM events)""")
def missing_profile(spark, folder):
    events = table(spark, folder, "events")
    value = (F.when(F.col("event_type") == "click", F.lit(float("nan")))
             .when(F.col("event_type") != "error", F.col("value")))
    return ops.missing_profile(events.select(value.alias("value"), F.nullif("user_id", F.lit(8)).alias("user_id"), "props"))


GAPS = ("SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, "
        "nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem")


def _gaps(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"))


@query("drop_missing", f"""
SELECT * FROM ({GAPS}) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL""")
def drop_missing(spark, folder):
    return ops.drop_missing(_gaps(spark, folder))


@query("drop_missing_subset", f"""
SELECT * FROM ({GAPS}) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL""")
def drop_missing_subset(spark, folder):
    return ops.drop_missing(_gaps(spark, folder), ["l_discount", "l_tax"])


@query("complete_case_mask", f"""
SELECT l_orderkey, l_linenumber, (l_discount IS NOT NULL AND l_tax IS NOT NULL) AS usable FROM ({GAPS})""")
def complete_case_mask(spark, folder):
    df = _gaps(spark, folder)
    return df.select("l_orderkey", "l_linenumber", ops.complete(df, ["l_discount", "l_tax"]).alias("usable"))


@query("row_accounting", f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE ok) AS rows_after, count(*) FILTER (WHERE NOT ok) AS rows_dropped
FROM (SELECT l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL AS ok FROM ({GAPS}))""")
def row_accounting(spark, folder):
    return ops.row_accounting(_gaps(spark, folder))


@query("tolerant_cast", """
SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'N/A' ELSE props->>'$.k' END AS DOUBLE) AS k,
 TRY_CAST(event_type AS DOUBLE) AS event_type FROM events""")
def tolerant_cast(spark, folder):
    dirty = F.when(F.col("event_type") == "error", "N/A").otherwise(F.get_json_object("props", "$.k"))
    events = table(spark, folder, "events").select("event_id", dirty.alias("k"), "event_type")
    return ops.cast_columns(events, ["k", "event_type", "no_such_column"])


@query("select_rename_drop", """
SELECT p_partkey AS part, p_name, p_retailprice AS price FROM part""")
def select_rename_drop(spark, folder):
    return ops.reshape_columns(table(spark, folder, "part"), {"p_partkey": "part", "p_retailprice": "price"},
                               ["p_brand", "p_type", "p_size", "not_there"])


@query("required_columns", """
SELECT o_orderkey, o_totalprice FROM orders""")
def required_columns(spark, folder):
    needed = ["o_orderkey", "o_totalprice"]
    return ops.require_rows(ops.require_columns(table(spark, folder, "orders"), needed)).select(*needed)


@query("preview_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20""")
def preview_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ops.preview(orders, 20, ["o_orderkey"])
