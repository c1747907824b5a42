import random

import numpy as np

from terrasift.llm import chunks
from terrasift.llm.chunks import repeated_spans


def brute(rows):
    """{doc_id: covered word positions} of windows of 50 words that two documents share."""
    held = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - 49):
            held.setdefault(tuple(words[k:k + 50]), []).append((doc_id, k))
    found = {}
    for places in held.values():
        if len({d for d, _ in places}) > 1:
            for d, k in places:
                found.setdefault(d, set()).update(range(k, k + 50))
    return found


def check(got, rows):
    """Every shared passage is found, nothing else is, and spans lie on the text they claim."""
    want, texts = brute(rows), dict(rows)
    assert {r.doc_id for r in got} == set(want)
    covered = {}
    for r in got:
        part = texts[r.doc_id][r.start:r.end]
        assert len(part.encode().split()) == r.n_words >= 50 and part == part.strip()
        at = len(texts[r.doc_id][:r.start].encode().split())
        covered.setdefault(r.doc_id, set()).update(range(at, at + r.n_words))
    for d, positions in covered.items():
        assert len(positions & want[d]) >= 0.99 * len(want[d]), d  # every shared word, to the ends of a passage
        assert len(positions & want[d]) >= 0.9 * len(positions)


def test_whole_table(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(repeated_spans(docs).collect(), [(r["doc_id"], r["text"]) for r in small_documents])


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


def test_planted_passages(spark, documents):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(80)]
    for size in (30, 45, 49, 50, 51, 52, 60, 120):
        passage = prose(rng, size)
        for k in rng.sample(range(80), 2):  # at any offset, so that the passage is shifted
            words = texts[k].split(" ")
            at = rng.randint(0, len(words))
            texts[k] = " ".join(words[:at]) + "\n " + passage + "\t" + " ".join(words[at:])
    rows = list(enumerate(texts))
    found = brute(rows)
    assert len(found) > 6
    check(repeated_spans(documents(texts)).collect(), rows)


def test_word_recall_at_every_length(spark, documents):
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(60)]
    for k, size in enumerate([50, 55, 60, 68, 70, 80, 90, 100, 120, 160, 200, 300, 400, 500]):
        passage = prose(rng, size)
        for d in (2 * k, 2 * k + 1):
            words = texts[d].split(" ")
            at = rng.randint(0, len(words))
            texts[d] = " ".join(words[:at] + [passage] + words[at:])
    for k in range(30, 40):  # parts of different lengths of one passage, and whole copies of it
        texts[k] += " " + " ".join(passage.split(" ")[rng.randint(0, 200):rng.randint(280, 500)])
    check(repeated_spans(documents(texts)).collect(), list(enumerate(texts)))


def test_gear_depends_on_the_roll_alone():
    rng = np.random.default_rng(1)
    gears = rng.integers(0, 2**63, 400).astype(np.uint64)
    want = [sum(int(g) << 2 * k for k, g in enumerate(gears[i - 31:i + 1][::-1])) % 2**64 for i in range(31, 400)]
    assert chunks.gear_hashes(gears)[31:].tolist() == want
    shifted = np.concatenate([rng.integers(0, 2**63, 7).astype(np.uint64), gears])
    a, b = set(chunks.cuts(gears)), {k - 7 for k in chunks.cuts(shifted)}
    assert {k for k in a if k > 60} <= b and max(np.diff(sorted(a))) <= chunks.SPREAD


def test_first_document_and_copies(spark, documents):
    rng = random.Random(8)
    text = prose(rng, 200)
    got = repeated_spans(documents([(5, text), (9, text), (9, text), (7, "x " + text), (1, prose(rng, 200)), (None, text)])).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(5, 5), (9, 5), (7, 5), (None, 5)}


def test_odd_rows(spark, odd_documents, documents):
    got = repeated_spans(odd_documents)
    assert got.columns == ["doc_id", "start", "end", "n_words", "first_doc_id"] and got.count() == 0
    assert repeated_spans(odd_documents.limit(0)).count() == 0
    extra = documents(["word " * 5000, "word " * 90 + "end"]).selectExpr("*", "1 AS row", "2 AS digest", "3 AS last")
    assert {r.doc_id for r in repeated_spans(extra).collect()} == {0, 1}
