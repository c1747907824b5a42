"""Quality rules: stated counts, and likeness to trusted text by hashed n-grams.

Every text becomes the bag of its hashed words and word pairs. One multinomial
over the ``BUCKETS`` hash values is counted on trusted documents and one on all
documents; a text is judged by the mean, over its n-grams, of the logarithm of
the ratio of the two. A text is kept if that mean reaches ``LEAST``, a fixed
threshold, so every document gets the same verdict in every run.

Only DataFrame functions are used. Counts cover all documents. Trusted are all
rows labelled of quality 1; they meet the documents by a shuffle on ``doc_id``.

Defined cases: a null or blank text has no words and fails the stated rules; with
no trusted documents the ratio is zero for all and the stated rules decide; rows
with one ``doc_id`` are judged each by its text; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged, words

BUCKETS = 10_000
LEAST = -0.045
SMOOTHING = 1.0
WINDOW, FEWEST_WORDS, REPEAT_PERCENT = 5, 10, 20
# Fixed characters that count as symbols, and the white space that is no part of words.
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\f\r"


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def ngrams(array: Column) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    def bucket(*parts):
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")

    singles = F.transform(array, lambda w: bucket(w))
    pairs = F.transform(F.slice(array, 2, F.greatest(F.size(array) - 1, F.lit(0))), lambda w, k: bucket(array[k], w))
    return F.concat(singles, pairs)


def repeated_words(array: Column) -> Column:
    """How many words lie in a window of five that occurs more than once in the text."""
    def covered(ordered):
        twice = F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["hash"] == x["hash"]) | (F.get(ordered, k + 1)["hash"] == x["hash"]))
        starts = F.array_sort(F.transform(twice, lambda x: x["at"]))
        first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(starts, first, lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), at + WINDOW - acc["end"])).cast("long").alias("n"), (at + WINDOW).alias("end")))["n"]

    def count(hashes):
        pairs = F.transform(hashes, lambda h, k: F.struct(h.alias("hash"), k.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bound(F.sort_array(pairs), covered))

    last = F.size(array) - WINDOW
    hashes = F.transform(F.sequence(F.lit(0), last), lambda k: F.xxhash64(*[array[k + j] for j in range(WINDOW)]))
    return F.when(last < 1, F.lit(0).cast("long")).otherwise(bound(hashes, count))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    return bound(F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0),
                 lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def log_ratios(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with the array ``ratios``: the log ratio of each bucket, trusted to all."""
    trusted = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id")).distinct()
    # Shuffled at every size, so that the work grows with the input; rows without an id stay where they lie.
    known = documents.filter("doc_id IS NOT NULL").join(trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("trusted_id"), "left")
    rows = known.select("text", F.col("trusted_id").isNotNull().cast("int").alias("trusted")).unionByName(
        documents.filter("doc_id IS NULL").select("text", F.lit(0).alias("trusted")))
    rows = rows.select(words(F.col("text")).alias("words"), "trusted")
    grams = rows.select("trusted", F.explode(ngrams(F.col("words"))).alias("bucket"))
    counts = staged(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("all"), F.sum("trusted").alias("good")), "ngrams")
    totals = counts.agg(F.coalesce(F.sum("all"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("m")).first()
    every = documents.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    ratio = F.log((F.coalesce("good", F.lit(0)) + SMOOTHING) / (totals["m"] + SMOOTHING * BUCKETS)) - F.log(
        (F.coalesce("all", F.lit(0)) + SMOOTHING) / (totals["n"] + SMOOTHING * BUCKETS))
    if not totals["m"]:
        ratio = F.lit(0.0)
    filled = every.join(counts, "bucket", "left").select("bucket", ratio.alias("ratio"))
    ordered = F.sort_array(F.collect_list(F.struct("bucket", "ratio")))
    return staged(filled.agg(ordered["ratio"].alias("ratios")), "ratios")


def judge_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the stated counts, ``ratio``, base_failed and kept of every document."""
    documents = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ratios = log_ratios(documents, labels)
    symbols, blanks = F.translate("text", SYMBOLS, ""), F.translate("text", BLANKS, "")
    # The ratios are one row of fixed size; as a scalar subquery they reach the executors once.
    rows = documents.select(
        "doc_id", words(F.col("text")).alias("words"), F.length(blanks).cast("long").alias("word_chars"),
        (F.length("text") - F.length(symbols)).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"), ratios.scalar().alias("ratios"))
    grams = ngrams(F.col("words"))
    total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.col("ratios")[b])
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.when(F.size("words") == 0, F.lit(0.0)).otherwise(total / (2 * F.size("words") - 1)).alias("ratio"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= LEAST))
