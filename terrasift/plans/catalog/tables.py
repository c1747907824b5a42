"""Readers, sniffing, header rules, sinks, pending work."""

from pyspark.sql import functions as F

from terrasift.operators import metrics
from terrasift.plans import tabular
from terrasift.plans.catalog import query, table
from terrasift.session import scratch_path
from terrasift.sources import headers, images, sinks, sniff
from terrasift.sources import tables as io
from terrasift.streaming import incremental


@query("csv_roundtrip", "SELECT * FROM part")
def csv_roundtrip(spark, folder):
    part = table(spark, folder, "part")
    target = scratch_path(spark, "part-csv")
    sinks.write_csv(part, target)
    return io.read_csv(spark, target, part.schema, name="part")


@query("csv_inferred_types", "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_acctbal FROM customer")
def csv_inferred_types(spark, folder):
    target = scratch_path(spark, "customer-csv")
    sinks.write_csv(table(spark, folder, "customer"), target)
    return io.read_csv(spark, target).select(F.col("c_custkey").cast("bigint"), "c_name", "c_acctbal")


@query("csv_single_file", """
SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer GROUP BY ALL""")
def csv_single_file(spark, folder):
    """A small report over a large table, written as one file."""
    counts = table(spark, folder, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("customers"))
    target = scratch_path(spark, "report-csv")
    sinks.write_single_csv(counts, target)
    return io.read_csv(spark, target, counts.schema, name="report")


@query("multi_dataset_ingest", """
SELECT 'customer' AS dataset, count(*) AS rows_before, count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD') AS rows_after,
 count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS rows_dropped, 'ok' AS status FROM customer
UNION ALL SELECT 'supplier', count(*), count(*), 0, 'ok' FROM supplier
UNION ALL SELECT 'part', count(*), count(*) FILTER (WHERE p_size <> 11), count(*) FILTER (WHERE p_size = 11), 'ok' FROM part
UNION ALL SELECT 'absent', NULL, NULL, NULL, 'failed'""")
def multi_dataset_ingest(spark, folder):
    frames = {
        "customer": table(spark, folder, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("HOUSEHOLD"))),
        "supplier": table(spark, folder, "supplier"),
        "part": table(spark, folder, "part").withColumn("p_size", F.nullif("p_size", F.lit(11))),
    }
    root = scratch_path(spark, "ingest")
    for name, df in frames.items():
        sinks.write_csv(df, f"{root}/{name}")
    sources = {name: f"{root}/{name}" for name in [*frames, "absent"]}
    return tabular.ingest(spark, sources, {name: df.schema for name, df in frames.items()})


@query("csv_sniff", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_sniff(spark, folder):
    target = scratch_path(spark, "customer-semicolon")
    sinks.write_csv(table(spark, folder, "customer"), target, sep=";")
    found = sniff.read_delimited(spark, target)
    return found.select(F.col("c_custkey").cast("bigint"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("csv_sniff_gbk", """
SELECT CAST(s_suppkey AS BIGINT) AS "编号", '供应商' || s_name AS "名称", s_acctbal AS "余额" FROM supplier""")
def csv_sniff_gbk(spark, folder):
    """Tab-separated GBK text with Chinese headers and values."""
    target = scratch_path(spark, "supplier-gbk")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("编号"), F.concat(F.lit("供应商"), "s_name").alias("名称"), F.col("s_acctbal").alias("余额"))
    sinks.write_csv(rows, target, sep="\t", encoding="GBK")
    return sniff.read_delimited(spark, target).withColumn("编号", F.col("编号").cast("bigint"))


@query("csv_sniff_whitespace", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def csv_sniff_whitespace(spark, folder):
    """Columns separated by runs of blanks, names given by the caller."""
    target = scratch_path(spark, "orders-blanks")
    table(spark, folder, "orders").select(
        F.concat_ws("   ", F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"),
                    "o_orderstatus").alias("value")).write.text(target)
    return sniff.read_delimited(spark, target, names=["o_orderkey", "o_totalprice", "o_orderstatus"])


@query("header_normalize", """
SELECT p_partkey AS "编号", p_retailprice AS "mb1", CAST(p_size AS DOUBLE) AS "mB2", p_name AS "深度(Km)" FROM part""")
def header_normalize(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double"), "p_name")
    raw = part.toDF(" 编号", "mb ", "mB", "深度（Km） ")
    return headers.apply_safe_names(headers.clean_headers(raw))


@query("duplicate_headers_csv", """
SELECT CAST(p_partkey AS BIGINT) AS id, p_retailprice AS mb1, CAST(p_size AS DOUBLE) AS "mB2" FROM part""")
def duplicate_headers_csv(spark, folder):
    """What the CSV reader itself makes of ``mb, mB``."""
    target = scratch_path(spark, "dup-headers")
    rows = table(spark, folder, "part").select(
        F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_retailprice").cast("string"),
                    F.col("p_size").cast("double").cast("string")).alias("id,mb,mB"))
    rows.write.option("header", True).option("quote", "\u0000").option("sep", "|").csv(target)
    return io.read_csv(spark, target).withColumn("id", F.col("id").cast("bigint"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("class_dir_scan", """
SELECT event_type AS label, CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS INTEGER) AS label_id, count(*) AS lines,
 CAST(sum(length(props) + 1) AS BIGINT) AS bytes FROM events GROUP BY event_type""")
def class_dir_scan(spark, folder):
    """Events as text files, one directory per type, read back as binary files."""
    target = scratch_path(spark, "event-dirs")
    (table(spark, folder, "events").select(F.col("props").alias("value"), F.col("event_type").alias("label"))
     .write.option("maxRecordsPerFile", 10_000).partitionBy("label").text(target))
    files = images.with_class(images.scan_files(spark, target, ["txt"]), EVENT_TYPES)
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    return files.groupBy("label", "label_id").agg(F.sum(lines).alias("lines"), F.sum("length").alias("bytes"))


@query("idempotent_pending", """
SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')""")
def idempotent_pending(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    target = scratch_path(spark, "done")
    events.filter(F.col("event_type").isin("click", "view")).write.parquet(target)
    return sinks.pending(events, spark.read.parquet(target), "event_id")


def _scored_events(spark, folder):
    """Events with a path per user and a rule as the predicted type."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("root/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"), F.lit(".jpg")).alias("path"),
        "event_id", "event_type", F.when(F.col("value") > 20, "view").otherwise(F.col("event_type")).alias("predicted"))


@query("quarantine_rows", """
SELECT 'root/' || event_type || '/' || user_id || '.jpg' AS path, min(event_id) AS event_id, event_type,
 'view' AS predicted, event_type AS label FROM events WHERE value > 20 AND event_type <> 'view'
GROUP BY event_type, user_id""")
def quarantine_rows(spark, folder):
    scored = _scored_events(spark, folder)
    wrong = metrics.misclassified(scored, "event_type", "predicted")
    target = scratch_path(spark, "quarantine")
    sinks.write_partitioned(sinks.quarantine(wrong), target, "label")
    return spark.read.parquet(target)


CLASS_SQL = """CASE {0} WHEN 0 THEN 'Cyclone' WHEN 1 THEN 'Earthquake' WHEN 2 THEN 'Flood' WHEN 3 THEN 'Wildfire'
 ELSE '未知(' || {0} || ')' END"""


def _scored_pages(spark, folder):
    return table(spark, folder, "pages").select(
        F.col("url").alias("path"), (F.col("page_id") % 5).cast("int").alias("label_id"),
        (F.length("url") % 5).alias("prediction"))


@query("predictions_tsv", f"""
SELECT url AS "图像路径", {CLASS_SQL.format('page_id % 5')} AS "真实值", {CLASS_SQL.format('length(url) % 5')} AS "预测值" FROM pages""")
def predictions_tsv(spark, folder):
    target = scratch_path(spark, "predictions-tsv")
    sinks.write_predictions_tsv(_scored_pages(spark, folder), target)
    schema = ", ".join(f"`{c}` string" for c in (sinks.PATH, sinks.TRUE, sinks.PRED))
    return io.read_csv(spark, target, schema, sep="\t")


@query("error_paths", "SELECT url AS path FROM pages WHERE page_id % 5 <> length(url) % 5")
def error_paths(spark, folder):
    target = scratch_path(spark, "error-paths")
    sinks.write_error_paths(_scored_pages(spark, folder), target)
    return spark.read.text(target).withColumnRenamed("value", "path")


def _batch_rows(spark, folder):
    return _scored_events(spark, folder).select(
        "path", F.col("event_type").alias("true_label"), "predicted", F.lit(0.5).alias("confidence"), F.lit("ok").alias("status"))


@query("batch_prediction_files", """
SELECT 'all' AS file, 'root/' || event_type || '/' || user_id || '.jpg' AS "图像路径", event_type AS "真实标签(推断)",
 CASE WHEN value > 20 THEN 'view' ELSE event_type END AS "预测值", 0.5::DOUBLE AS "置信度" FROM events
UNION ALL SELECT 'incorrect', 'root/' || event_type || '/' || user_id || '.jpg', event_type, 'view', 0.5::DOUBLE
FROM events WHERE value > 20 AND event_type <> 'view'""")
def batch_prediction_files(spark, folder):
    root = scratch_path(spark, "batch")
    sinks.write_batch_predictions(_batch_rows(spark, folder), f"{root}/all", f"{root}/incorrect")
    schema = f"`{sinks.PATH}` string, `{sinks.INFERRED_TRUE}` string, `{sinks.PRED}` string, `{sinks.CONFIDENCE}` double, status string"
    parts = [io.read_csv(spark, f"{root}/{kind}", schema).select(F.lit(kind).alias("file"), "*").drop("status")
             for kind in ("all", "incorrect")]
    return parts[0].unionAll(parts[1])


@query("label_prediction_file", """
SELECT o_totalprice, o_totalprice * 2 AS "预测值" FROM orders""")
def label_prediction_file(spark, folder):
    target = scratch_path(spark, "label-predictions")
    scored = table(spark, folder, "orders").select("o_totalprice", (F.col("o_totalprice") * 2).alias("prediction"))
    sinks.write_label_predictions(scored, target, "o_totalprice")
    return io.read_csv(spark, target, f"o_totalprice double, `{sinks.PRED}` double")


@query("stream_clean_tables", """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_name FROM part WHERE p_size <> 11""")
def stream_clean_tables(spark, folder):
    """CSV files cleaned by two incremental runs; the second finds nothing new."""
    root = scratch_path(spark, "stream")
    part = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") != 11, F.col("p_size")).alias("p_size"), "p_name")
    sinks.write_csv(part, f"{root}/in")
    for _ in range(2):
        incremental.clean_new_tables(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint",
                                     "p_partkey string, p_size string, p_name string", ["p_partkey", "p_size"])
    return spark.read.parquet(f"{root}/out")


@query("clean_while_counting", """
SELECT count(*) AS rows_before, count(*) FILTER (c_mktsegment <> 'HOUSEHOLD') AS rows_after, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS rows_dropped,
 count(*) FILTER (c_mktsegment <> 'HOUSEHOLD') AS written FROM customer""")
def clean_while_counting(spark, folder):
    """A CSV with gaps is cleaned and written; its rows are counted in the same scan."""
    source, target = scratch_path(spark, "gaps-csv"), scratch_path(spark, "clean-csv")
    gap = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal"))
    dirty = table(spark, folder, "customer").select("c_custkey", gap.alias("c_acctbal"))
    sinks.write_csv(dirty, source)
    counts = tabular.clean_file(spark, source, target, dirty.schema)
    return counts.withColumn("written", F.lit(io.read_csv(spark, target, dirty.schema).count()))


@query("bad_records", """
SELECT o_orderstatus AS status, count(*) AS rows, count(*) FILTER (o_orderkey % 7 = 0) AS bad_rows, (3 * count(*) - count(*) FILTER (o_orderkey % 7 = 0))::BIGINT AS read_values, count(*) FILTER (o_orderkey % 7 = 0) > 0 AS has_example
FROM orders GROUP BY o_orderstatus""")
def bad_records(spark, folder):
    """Bad lines per file: one file for each status, in which the price of every seventh order is no number or a field is missing."""
    target = scratch_path(spark, "bad-lines")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("price"))
    line = F.when(F.col("o_orderkey") % 14 == 0, F.concat_ws(",", "o_orderkey", "price")).when(
        F.col("o_orderkey") % 7 == 0, F.concat_ws(",", "o_orderkey", F.lit("n/a"), F.lit("x"))).otherwise(F.concat_ws(",", "o_orderkey", "price", F.lit("x")))
    orders.select("o_orderstatus", line.alias("value")).write.partitionBy("o_orderstatus").text(target)
    parts = [r["o_orderstatus"] for r in orders.select("o_orderstatus").distinct().collect()]
    found = None
    for status in parts:
        read = io.read_checked(spark, f"{target}/o_orderstatus={status}", "key long, price double, mark string", header=False)
        counts = io.bad_record_accounting(read).agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"), F.sum("read_values").alias("read_values"), F.max(F.col("example").isNotNull()).alias("has_example"))
        counts = counts.select(F.lit(status).alias("status"), "rows", "bad_rows", "read_values", "has_example")
        found = counts if found is None else found.unionByName(counts)
    return found


@query("replaced_partitions", """
SELECT c_mktsegment AS segment, count(*) AS customers, CASE c_mktsegment WHEN 'BUILDING' THEN 2 ELSE 1 END AS version FROM customer GROUP BY c_mktsegment""")
def replaced_partitions(spark, folder):
    """A second run over one changed class replaces its directory and no other."""
    target = scratch_path(spark, "by-segment")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    sinks.replace_partitions(customers.withColumn("version", F.lit(1)), target, "segment")
    sinks.replace_partitions(customers.filter("segment = 'BUILDING'").withColumn("version", F.lit(2)), target, "segment")
    return io.read_table(spark, target).groupBy("segment", "version").agg(F.count(F.lit(1)).alias("customers"))
