import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from terrasift.llm import ranking
from terrasift.llm.ranking import FEATURES, keep_good, score_documents, text_features

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in score_documents(docs, labels).collect()}
    assert len(rows) == docs.count()
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [d for d in quality if rows[d].held_out]
    assert sum(rows[d].predicted == quality[d] for d in held) >= 0.95 * len(held)
    good, poor = ([rows[d].score for d in held if quality[d] == q] for q in (1, 0))
    assert sum(g > p for g in good for p in poor) >= 0.98 * len(good) * len(poor)


def test_held_out_labels_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in score_documents(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in score_documents(docs, flipped).collect()}


def test_quantiles_are_those_of_all_rows(spark):
    rng = np.random.default_rng(4)
    values = np.clip(np.concatenate([rng.normal(size=3_000), np.full(2_000, 0.25)]), -8, 8)
    got = ranking.quantile_cuts(spark.createDataFrame([(float(v),) for v in values], "worth double").repartition(7), 8.0)
    order = np.sort(values)
    want = order[np.ceil(np.arange(1, ranking.QUANTILES + 1) / (ranking.QUANTILES + 1) * len(order)).astype(int) - 1]
    assert all(np.abs(want - g).min() <= 16 / ranking.BINS for g in got) and all(np.abs(np.array(got) - w).min() <= 16 / ranking.BINS for w in want)


def test_features():
    assert len(text_features(None)) == len(FEATURES) and text_features(None) == text_features("")
    repeated, plain = (dict(zip(FEATURES, text_features(t))) for t in ("a b " * 50, "one two three four five six seven"))
    assert repeated["words seen before"] > 0.8 > plain["words seen before"]
    shouted = dict(zip(FEATURES, text_features("SHOUT AT ME!! " * 9)))
    assert shouted["capitals"] > 0.4 and shouted["exclamations"] > 0.05


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, 0), (6, 0, 0), (7, 0, 1), (0, 0, 0), (9, None, 0), (None, 1, 0)], LABELS)
    rows = score_documents(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    one_label = score_documents(odd_documents, labels.filter("quality = 1"))
    assert {(r.score, r.predicted) for r in one_label.collect()} == {(0.5, 1)}
    assert score_documents(odd_documents.limit(0), labels).count() == 0
    extra = odd_documents.selectExpr("*", "1 AS quality", "2 AS worth", "3 AS features", "4 AS number")
    kept = keep_good(extra, labels.selectExpr("*", "'x' AS text"))
    assert kept.columns == extra.columns and kept.count() <= extra.count()
    assert keep_good(odd_documents, labels.limit(0)).count() == odd_documents.count()
