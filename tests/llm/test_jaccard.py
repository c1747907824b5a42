import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.llm import jaccard
from terrasift.llm.jaccard import Shingler, jaccard_groups, shared_entries


def brute_set(text):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\f\r":
        line = line.replace(space, " ")
    words = [w for w in line.split(" ") if w]
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """rows: (doc_id, text) with distinct ids; every pair is compared."""
    sets = {d: brute_set(t) for d, t in rows}
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return sorted((d, len(sets[d]), root(d)) for d in ids)


def check(docs, rows, **settings):
    got = jaccard_groups(docs, **settings)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    return want


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    base = rng.choices(vocabulary, k=90)
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(90):  # one dense group on both sides of the threshold
        words = base[:]
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    chain = rng.choices(vocabulary, k=60)
    for k in range(30):  # neighbours are near, the ends are not
        chain = chain[2:] + rng.choices(vocabulary, k=2)
        texts.append(" ".join(chain))
    for _ in range(40):  # a passage that many otherwise different texts share
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(5, 40)) + passage + rng.choices(vocabulary, k=rng.randint(0, 30))))
    for _ in range(30):  # short texts around the length of a shingle
        texts.append(" ".join(rng.choices(["a", "B", "b", "c"], k=rng.randint(0, 9))))
    for k in range(30):  # equal prefixes and sizes: sets that differ in frequent shingles only
        texts.append(" ".join(base[:80]) + f" x{k % 3} y{k % 5}")
    return list(enumerate(texts + texts[:12]))


def test_near_texts(spark, documents, near_texts):
    want = check(documents(near_texts).repartition(4), near_texts)
    assert 20 < len({c for _, _, c in want}) < len(want)


def test_small_cells_without_pivots(spark, documents, near_texts):
    check(documents(near_texts).repartition(3), near_texts, rounds=0, chunk=300)


def test_small_cells_with_pivots(spark, documents, near_texts, monkeypatch):
    monkeypatch.setattr("terrasift.llm.common.HOT_ROWS", 5)
    check(documents(near_texts), near_texts, rounds=1, chunk=150)


def test_whole_table(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in small_documents])


def test_shingles_count_like_words():
    shingles = Shingler()
    for text in (None, "", "a", "A b c D", "a b c d e", "a b c d e f a b c d e", "x " * 50, "Ä ä É é ß ſ", "a\x0bb\fc\td\ne f\x1fg"):
        assert len(shingles(text)) == len(brute_set(text))
    assert (shingles("a b c d E f") == shingles("A B\nC  D e F ")).all()
    assert len(np.intersect1d(shingles("a b c d e"), shingles("e d c b a"))) == 0


def test_entries_keep_what_is_shared_and_the_ends_of_ranges(spark):
    rng = random.Random(3)
    rows = {(rng.randrange(300), rng.randrange(2_000)) for _ in range(500)} | {(7, k) for k in range(400)}
    lists = {}
    for token, gid in rows:
        lists.setdefault(gid, []).append(token)
    marks = [(gid, len(tokens), tokens) for gid, tokens in lists.items()] + [(gid, len(tokens), tokens) for gid, tokens in list(lists.items())[:50]]
    got = {(r.token, r.gid) for r in shared_entries(spark.createDataFrame(marks, "gid long, n long, prefix array<long>").repartition(5)).collect()}
    shared = {(t, g) for t, g in rows if sum(g != other and t in lists[other] for other in lists)}
    assert shared <= got <= rows and len(got - shared) <= 16


def test_bitmaps_lose_no_link(monkeypatch):
    rng = np.random.default_rng(5)
    sets = []
    for size in (3, 20, 60, 64, 65, 130, 250, 1000):
        base = rng.integers(-2**63, 2**63 - 1, size)
        sets += [np.unique(np.concatenate([base[:size - cut], rng.integers(-2**63, 2**63 - 1, add)])) for cut in (0, 1, size // 9, size // 5, size // 2)
                 for add in (0, 1, size // 10, size // 3)]
    sizes = np.array([len(s) for s in sets])
    keep = jaccard.partnered(sizes, np.zeros(len(sets), np.int64), [jaccard.parity_bitmap(s) for s in sets])
    linked = [any(100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets if b is not a) for a in sets]
    assert all(k for k, want in zip(keep, linked) if want) and not keep.all()
    few = jaccard._partnered_few(sizes.tolist(), [0] * len(sets), [jaccard.parity_bitmap(s) for s in sets])
    assert list(few) == keep.tolist()
    assert jaccard.partnered(sizes, sizes * 0, [None, *[b"x" * 8] * (len(sets) - 1)]).all()
    monkeypatch.setattr(jaccard, "TESTS", 3)
    assert jaccard.partnered(sizes, sizes * 0, [jaccard.parity_bitmap(s) for s in sets]).all()


def test_odd_rows(spark, odd_documents):
    rows = odd_documents.collect()
    got = jaccard_groups(odd_documents.selectExpr("*", "1 AS n", "2 AS cid", "3 AS label", "4 AS gid"))
    found = sorted(map(tuple, got.collect()), key=str)
    assert len(found) == len(rows)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[0] == (0, 0) and by_id[1] == (0, 1) and by_id[2] == (0, 2)
    assert by_id[3] == (1, 3) and by_id[9] == (1, 8)  # four words: the whole sequence
    assert sum(r[0] == 3 for r in found) == 3
    assert sorted((r[1:] for r in found if r[0] is None), key=str) == [(0, None), (1, None)]


def test_copies_without_and_with_repeated_ids(spark, documents):
    text = "one two three four five six seven eight"
    got = jaccard_groups(documents([(None, text), (None, text), (5, text), (5, "quite another text of its own here"), (9, text + " nine")]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 4, 5), (None, 4, 5), (5, 4, 5), (5, 3, 5), (9, 5, 5)], key=str)
    assert jaccard_groups(documents([])).count() == 0
    assert jaccard_groups(documents([None, ""])).select(F.sum("n_shingles")).first()[0] == 0
