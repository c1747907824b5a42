"""Quality classifier: Bradley-Terry ranking of documents.

A document's worth is a weighted sum of features of its whole text. The weights
come from preference pairs, a document labelled 1 against one labelled 0, by
logistic loss on the difference of their features. The score is the logistic of
the worth above a threshold, and the threshold is a quantile of the worth of
*all* documents: of 999 evenly spaced quantiles the one that parts the labelled
training rows best, in the middle if several do.

Only the fit uses a bounded sample: at most ``SAMPLE_PER_LABEL`` training rows of
each label, in the order of a hash of their id, and ``PAIRS`` pairs of them. The
threshold and the scores cover every row.

Defined cases: a null text counts as empty and is scored like any other; a null
label or id is not learned from; a document labelled twice counts with its
smallest label; if one label is missing, every score is 0.5 and predicted 1;
repeated rows get one score each; an empty table gives an empty result. Labels,
language, source and id are no features. Other columns are not read.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import staged

SAMPLE_PER_LABEL = 4_000
PAIRS = 40_000
QUANTILES = 999
BINS = 1 << 16  # of the range of worths, in which its quantiles are counted
FEATURES = ("length", "word length", "symbols", "bars", "capitals", "exclamations", "digits", "words seen before", "next word equal",
            "lines equal", "sentences equal", "commonest word", "short words", "windows equal", "punctuated words")
SYMBOLS, CAPITALS, DIGITS = b"#*$%&<>", bytes(range(65, 91)), b"0123456789"


def text_features(text: str | None) -> list[float]:
    """The features named by ``FEATURES``, of the whole text."""
    raw = (text or "").encode()
    found = raw.split()
    # Shares lean towards zero in short texts, where one capital or mark says little.
    n, size = len(found) + 10, len(raw) + 50

    def share(kind):
        return (len(raw) - len(raw.translate(None, kind))) / size

    def repeated(parts, few):
        return (len(parts) - len(set(parts))) / (len(parts) + few)

    counts: dict[bytes, int] = {}
    for word in found:
        counts[word] = counts.get(word, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sentences = [x for x in raw.replace(b"\n", b" ").split(b". ") if x.strip()]
    windows = list(zip(found, found[1:], found[2:], found[3:]))
    return [
        math.log1p(len(found)), min(20.0, sum(map(len, found)) / n), share(SYMBOLS), raw.count(b"|") / size, share(CAPITALS),
        raw.count(b"!") / size, share(DIGITS), (len(found) - len(counts)) / n, sum(map(eq, found, found[1:])) / n,
        repeated(lines, 3), repeated(sentences, 5), max(counts.values(), default=0) / n, sum(len(w) <= 3 for w in found) / n,
        repeated(windows, 10), sum(not w[-1:].isalnum() and w[-1] < 128 for w in found) / n]


def with_features(documents: DataFrame) -> DataFrame:
    """(doc_id, features) of each row."""
    def run(batches):
        for batch in batches:
            rows = [text_features(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, features array<double>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))


def fit_weights(documents: DataFrame, labels: DataFrame):
    """(mean, scale, weights) of the features, or None if a label has no document."""
    def first(value):
        return (labels.filter(F.col("quality") == value)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL))

    # At most two times SAMPLE_PER_LABEL ids, whatever the size of the tables.
    chosen = F.broadcast(first(0).unionByName(first(1)))
    rows = with_features(documents.join(chosen.select("doc_id"), "doc_id", "left_semi"))
    rows = staged(rows.join(chosen, "doc_id"), "sample")
    order = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id", "features")
    rows = rows.withColumn("number", F.row_number().over(order) - 1)
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    at = [F.col("features")[k] for k in range(len(FEATURES))]
    stats = rows.agg(*[F.avg(x) for x in at], *[F.stddev_pop(x) for x in at]).first()
    mean = np.array(stats[:len(FEATURES)])
    scale = np.array([s if s > 1e-9 else 1.0 for s in stats[len(FEATURES):]])

    def side(value):
        return rows.filter(F.col("quality") == value).select("number", F.col("features").alias(f"f{value}"))

    pairs = documents.sparkSession.range(PAIRS).select(
        "id", (F.col("id") % counts[1]).alias("good"), ((F.col("id") * 7919 + F.floor(F.col("id") / counts[1])) % counts[0]).alias("poor"))
    pairs = pairs.join(side(1), F.col("good") == F.col("number")).drop("number").join(side(0), F.col("poor") == F.col("number"))
    better = F.col("id") % 2 == 0  # each pair is told once, every other one from the loser's side
    # Differences are cut at four standard deviations, as scores are, so that no text outweighs the others.
    cut = [F.least(F.greatest((F.col(f"f{v}")[k] - float(mean[k])) / float(scale[k]), F.lit(-4.0)), F.lit(4.0))
           for k in range(len(FEATURES)) for v in (1, 0)]
    differences = [F.when(better, cut[2 * k] - cut[2 * k + 1]).otherwise(cut[2 * k + 1] - cut[2 * k]) for k in range(len(FEATURES))]
    training = pairs.select(array_to_vector(F.array(*differences)).alias("features"), better.cast("double").alias("label"))
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=1e-3, maxIter=50).fit(training)
    return mean, scale, model.coefficients.toArray()


def with_worth(documents: DataFrame, fitted) -> DataFrame:
    """(doc_id, worth) of every row."""
    mean, scale, weights = fitted

    def run(batches):
        for batch in batches:
            rows = np.array([text_features(x) for x in batch.column(1).to_pylist()]).reshape(-1, len(weights))
            worth = np.clip((rows - mean) / scale, -4, 4) @ weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(worth, pa.float64())], ["doc_id", "worth"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, worth double")


def farthest(fitted) -> float:
    """The largest worth there can be: features are cut at four deviations."""
    return max(4 * float(np.abs(fitted[2]).sum()), 1e-9)


def quantile_cuts(worth: DataFrame, reach: float) -> list[float]:
    """The ``QUANTILES`` quantiles of all worths, which lie within ``reach`` of 0, to within a ``BINS``-th of that range.

    The worths are counted in bins where they lie; only the counts, at most ``BINS`` + 1 at any size, meet.
    """
    place = F.floor((F.col("worth") + F.lit(reach)) / F.lit(2 * reach) * F.lit(BINS)).cast("int")
    found = worth.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin").toArrow()
    bins, upto = found.column(0).to_numpy(), np.cumsum(found.column(1).to_numpy())
    levels = np.array([(k + 1) / (QUANTILES + 1) for k in range(QUANTILES)]) * upto[-1]
    return sorted({float(x) for x in (bins[np.searchsorted(upto, levels)] + 1) / BINS * 2 * reach - reach})


def quantile_threshold(worth: DataFrame, labels: DataFrame, reach: float) -> float:
    """The quantile of all worths that leaves the fewest training rows on the wrong side."""
    cuts = quantile_cuts(worth, reach)
    # The position of a worth among the cuts, found on the JVM: how many cuts do not exceed it.
    above = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x <= F.col("worth")))
    counts = (worth.join(labels, "doc_id").withColumn("bin", above)
              .groupBy("bin").agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
                                  F.count(F.when(F.col("quality") == 0, 1)).alias("poor")).collect())
    good, poor = np.zeros(len(cuts) + 1), np.zeros(len(cuts) + 1)
    for r in counts:
        good[r["bin"]], poor[r["bin"]] = r["good"], r["poor"]
    # Cutting at cuts[k] rejects the bins up to k and keeps the others.
    wrong = np.cumsum(good)[:-1] / max(1, good.sum()) + (poor.sum() - np.cumsum(poor)[:-1]) / max(1, poor.sum())
    best = np.flatnonzero(wrong == wrong.min())
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    run = max(runs, key=len)
    return (cuts[run[0]] + cuts[run[-1]]) / 2


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    labels = staged(training_labels(labels), "labels")
    fitted = fit_weights(documents, labels)
    if fitted is None:
        rows = documents.select("doc_id", F.lit(0.0).alias("worth"))
        threshold = 0.0
    else:
        rows = staged(with_worth(documents, fitted), "worth")
        threshold = quantile_threshold(rows, labels, farthest(fitted))
    score = 1 / (1 + F.exp(F.lit(threshold) - F.col("worth")))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, as they are."""
    labels = staged(training_labels(labels), "labels")
    fitted = fit_weights(documents, labels)
    if fitted is None:
        return documents
    threshold = quantile_threshold(staged(with_worth(documents, fitted), "worth"), labels, farthest(fitted))
    mean, scale, weights = fitted
    own = documents.columns

    @F.arrow_udf("double")
    def worth(text):
        rows = np.array([text_features(x) for x in text.to_pylist()]).reshape(-1, len(weights))
        return pa.array(np.clip((rows - mean) / scale, -4, 4) @ weights, pa.float64())

    inner = documents.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), worth("text").alias("_worth"))
    return inner.filter(F.col("_worth") >= threshold).select(*[F.col("_row").getField(c).alias(c) for c in own])
