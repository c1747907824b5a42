"""Random, stratified and hold-out splits."""

from pyspark.sql import functions as F

from terrasift.operators import splits as ops
from terrasift.plans.catalog import query, table
from terrasift.session import scratch_path
from terrasift.sources import sinks

DRAW = "CAST(('0x' || substr(md5('1234|' || length(o_orderkey::VARCHAR) || ':' || o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query("random_split", f"""
SELECT o_orderkey, CASE WHEN {DRAW} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM orders""")
def random_split(spark, folder):
    return ops.random_split(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


@query("random_split_sizes", f"""
SELECT split, count(*) AS n FROM
 (SELECT CASE WHEN {DRAW} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM orders) GROUP BY split""")
def random_split_sizes(spark, folder):
    return ops.split_sizes(ops.random_split(table(spark, folder, "orders"), ["o_orderkey"]))


STRATIFIED = """
SELECT event_id, event_type, CASE WHEN rn <= c1 THEN 'train' WHEN rn <= c1 + c2 THEN 'val' ELSE 'test' END AS split
FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('1234|' || length(event_id::VARCHAR) || ':' || event_id)) rn,
 floor(0.7::DOUBLE * count(*) OVER (PARTITION BY event_type)) c1,
 floor(0.15::DOUBLE * count(*) OVER (PARTITION BY event_type)) c2 FROM events)"""


@query("stratified_split", STRATIFIED)
def stratified_split(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return ops.stratified_split(events, "event_type", ["event_id"])


@query("split_materialized", f"""
SELECT split, event_type AS label, count(*) AS n FROM ({STRATIFIED}) GROUP BY ALL""")
def split_materialized(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "label")
    target = scratch_path(spark, "split")
    sinks.write_partitioned(ops.stratified_split(events, "label", ["event_id"]), target, "split", "label")
    return ops.split_sizes(spark.read.parquet(target), "label")


@query("holdout_split", """
SELECT o_orderkey, CASE WHEN rn <= n - greatest(1, ceil(0.2::DOUBLE * n)) THEN 'train' ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || length(o_orderkey::VARCHAR) || ':' || o_orderkey)) rn, count(*) OVER () n FROM orders)""")
def holdout_split(spark, folder):
    return ops.holdout_split(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


@query("stratified_split_repeated_keys", """
SELECT event_type, split, CAST(CASE split WHEN 'train' THEN c1 WHEN 'val' THEN c2 ELSE n - c1 - c2 END AS BIGINT) AS n FROM
 (SELECT event_type, count(*) AS n, floor(0.7::DOUBLE * count(*)) c1, floor(0.15::DOUBLE * count(*)) c2 FROM events GROUP BY event_type),
 (SELECT unnest(['train', 'val', 'test']) AS split)""")
def stratified_split_repeated_keys(spark, folder):
    """A key that many rows share does not change the sizes; rows are down to two columns, so many are equal."""
    events = table(spark, folder, "events").select("user_id", "event_type")
    return ops.split_sizes(ops.stratified_split(events, "event_type", ["user_id"]), "event_type")


@query("holdout_split_repeated_keys", """
SELECT split, CAST(CASE split WHEN 'test' THEN t ELSE n - t END AS BIGINT) AS n FROM
 (SELECT count(*) AS n, greatest(1, ceil(0.2::DOUBLE * count(*))) AS t FROM orders), (SELECT unnest(['train', 'test']) AS split)""")
def holdout_split_repeated_keys(spark, folder):
    return ops.split_sizes(ops.holdout_split(table(spark, folder, "orders").select("o_custkey"), ["o_custkey"]))
