import math
import re
from collections import Counter

import numpy as np
import pytest

from terrasift.llm import search
from terrasift.llm.search import ImpactList, best_positions, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    """docs, items: lists of (id, text); every document is scored."""
    counted = [(d, Counter(brute_terms(t))) for d, t in docs]
    counted = [(d, t) for d, t in counted if t]
    n_docs, total = len(counted), sum(t.total() for _, t in counted)
    df = Counter(term for _, t in counted for term in t)
    out = []
    for item_id, text in {(i, t) for i, t in items if t}:
        scored = []
        for d, terms in counted:
            m, score = 75 + 25 * terms.total() * n_docs // total, 0
            for term in brute_terms(text):
                tf = terms[term]
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return out


def ordered(rows):
    return sorted(((*r,) for r in rows), key=str)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_terms_are_those_of_the_pattern():
    for text in (None, "", "A-b_c 9x", "ÄÖ ß é ÉE 漢字🙂x y\x7fz", "a\x00b~c d", "İK ſ"):
        assert [t.decode() for t in search.terms_of(text)] == brute_terms(text)


def test_small_texts_ties_and_blocks(spark, documents, monkeypatch):
    words = ["red", "blue", "Äpfel", "sun", "moon", "tree", "of", "it"]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words, rng.integers(1, 12)))) for k in range(60)]
    rows += [(100 + k, "moon tree") for k in range(30)] + [(7, rows[7][1]), (7, rows[7][1]), (None, "moon tree"), (None, "moon tree")]
    items = [(1, "moon TREE moon"), (2, "red, blue; of"), (3, "nothing here"), (4, None), (5, " "), (1, "sun"), (2, "red, blue; of"), (None, "äpfel Äpfel it")]
    want = ordered(brute(rows, items))
    docs = documents(rows)
    assert ordered(rank_documents(docs, items_table(spark, items)).collect()) == want
    monkeypatch.setattr(search, "BLOCK_ITEMS", 2)
    assert ordered(rank_documents(docs.repartition(5), items_table(spark, items)).collect()) == want


def test_whole_table(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in items.collect()][:12]
    want = ordered(brute([(r["doc_id"], r["text"]) for r in small_documents], rows))
    assert ordered(rank_documents(docs, items.filter(items.item_id.isin([i for i, _ in rows]))).collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_stops_only_when_nothing_better_is_left(seed, monkeypatch):
    monkeypatch.setattr(search, "STRIDE", 4)
    monkeypatch.setattr(search, "DENSE", 300)
    rng = np.random.default_rng(seed)
    size, lists, score = 3000, [], np.zeros(3000, np.int64)
    for k in range(12):
        rows = np.sort(rng.choice(size, rng.integers(1, size // (k + 1)), replace=False))
        impacts = rng.integers(0, 60, len(rows)) * (k + 1) ** 2
        times = int(rng.integers(1, 3))
        lists.append((ImpactList(rows, impacts, size), times))
        score[rows] += times * impacts
    rows, found = best_positions(lists, size, 20)
    assert (score[rows] == found).all() and len(set(rows.tolist())) == len(rows)
    kth = np.sort(score)[-20]
    assert set(np.flatnonzero(score >= max(kth, 1)).tolist()) == set(rows.tolist())  # all ties with the k-th are there
    assert len(best_positions(lists, size, 20, int(score.max()) + 1)[0]) == 0


def test_reads_less_than_everything():
    size = 20_000
    rng = np.random.default_rng(9)
    lists, score = [], np.zeros(size, np.int64)
    common = rng.permutation(size)
    for k in range(3):
        impacts = np.sort(rng.integers(0, 1_000_000, size))[::-1][np.argsort(common)] if k else rng.integers(0, 1_000_000, size)
        lists.append((ImpactList(np.arange(size), impacts, size), 1))
        score += impacts
    reads = []
    lists[0][0].places_of, inner = (lambda wanted: reads.append(len(wanted)) or inner(wanted)), lists[0][0].places_of
    rows, _ = best_positions(lists, size, 20)
    assert set(np.argsort(-score, kind="stable")[:20].tolist()) <= set(rows.tolist())
    assert sum(reads) < size


def test_odd_rows(spark, odd_documents, documents):
    items = items_table(spark, [(1, "word same TEXT"), (2, "é 漢字"), (3, "x" * 30_000)])
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = rank_documents(odd_documents.selectExpr("*", "1 AS rank", "2 AS item_id", "3 AS score"), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(got.collect()) == ordered(brute(rows, [(1, "word same TEXT"), (2, "é 漢字"), (3, "x" * 30_000)]))
    assert rank_documents(documents([]), items).count() == 0
    assert rank_documents(documents([None, " - "]), items).count() == 0
    assert rank_documents(odd_documents, items.limit(0)).count() == 0
