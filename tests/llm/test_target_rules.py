import math
from collections import Counter

import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from terrasift.llm import target_rules
from terrasift.llm.target_rules import judge_documents

FOLDER = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    """The stated counts, as stated."""
    words = (text or "").encode().split()
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered)


def buckets(text):
    """Buckets of words and pairs; hashes of several words are chained as Spark chains them."""
    words = (text or "").encode().split()

    def signed(x):
        return x - (1 << 64) if x >> 63 else x
    firsts = [xxhash.xxh64_intdigest(w, 42) for w in words]
    pairs = [xxhash.xxh64_intdigest(w, h) for h, w in zip(firsts, words[1:])]
    return [signed(h) % target_rules.BUCKETS for h in firsts + pairs]


def ratios(rows, trusted):
    every, good = Counter(), Counter()
    for doc_id, text in rows:
        every.update(buckets(text))
        if doc_id in trusted:
            good.update(buckets(text))
    n, m = sum(every.values()), sum(good.values())
    return lambda b: math.log((good[b] + 1) / (m + target_rules.BUCKETS)) - math.log((every[b] + 1) / (n + target_rules.BUCKETS))


def check(got, rows, trusted):
    ratio = ratios(rows, trusted)
    assert len(got) == len(rows)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text)
    for r in got:
        want = {}
        for text in texts[r.doc_id]:
            found = buckets(text)
            mean = sum(map(ratio, found)) / len(found) if found and any(d in trusted for d, _ in rows) else 0.0
            want[counts(text)] = mean
        key = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert key in want and abs(r.ratio - want[key]) < 1e-9
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.ratio >= target_rules.LEAST)


def test_whole_table(spark, small_documents):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    got = judge_documents(docs, labels).collect()
    check(got, [(r["doc_id"], r["text"]) for r in small_documents], {d for d, q in known.items() if q == 1})
    kept = {r.doc_id for r in got if r.kept}
    fit = [r.doc_id for r in got if known.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(d in kept for d in fit) >= 0.98 * len(fit)


def test_repeats_lines_and_symbols(spark, documents):
    texts = ["a b c d e f g h i j", "a b c d e x a b c d e", "a " * 30, "x y\n\nx y\n x y\nx y\n \n ", "# * $ % & | < >\x0bé\x1f", "one two three four five one two three four five six one two three four five"]
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], LABELS)
    check(judge_documents(documents(texts), labels).collect(), list(enumerate(texts)), {0})


def test_every_trusted_row_counts(spark):
    """Where all rows are trusted, the two multinomials are one, at any number of rows."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = rows.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert judge_documents(rows, labels).agg(F.max(F.abs("ratio"))).first()[0] == 0.0


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 1, 0)], LABELS)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(judge_documents(odd_documents, labels).collect(), rows, {5})
    check(judge_documents(odd_documents, labels.limit(0)).collect(), rows, set())
    assert judge_documents(odd_documents.limit(0), labels).count() == 0
    extra = odd_documents.selectExpr("*", "1 AS words", "2 AS ratios", "3 AS bucket", "4 AS trusted_id")
    assert judge_documents(extra, labels.selectExpr("*", "1 AS text")).count() == len(rows)
