import random

import pyarrow.parquet as pq

from terrasift.llm import contamination
from terrasift.llm.contamination import contaminated, item_shingles, sketches, without_contamination

SCHEMA = "item_id long, text string"


def shingles(words, length):
    return {tuple(words[k:k + length]) for k in range(len(words) - length + 1)}


def brute(documents, items):
    """{(doc_id, item_id): (size, found)} with every item held against every document."""
    out = {}
    for item_id, text in items:
        words = (text or "").lower().split()
        length = min(5, len(words))
        own = shingles(words, length) if words else set()
        for doc_id, body in documents:
            found = len(own & shingles((body or "").lower().split(), length)) if own else 0
            if own and 10 * found >= 8 * len(own):
                out[doc_id, item_id] = max(out.get((doc_id, item_id), (0, 0)), (len(own), found))
    return out


def got(df):
    rows = df.collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    assert all(r.containment == r.n_found / r.n_shingles for r in rows)
    return {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in rows}


def test_whole_table(spark, small_documents):
    folder = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = [(r["item_id"], r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    want = brute([(r["doc_id"], r["text"]) for r in small_documents], rows)
    assert want and got(contaminated(docs, items)) == want
    kept = {r.doc_id for r in without_contamination(docs, items).collect()}
    assert kept == {r["doc_id"] for r in small_documents} - {d for d, _ in want}


def test_edited_and_short_items(spark, documents, monkeypatch):
    monkeypatch.setattr(contamination, "SKETCH_BLOCK", 7)  # so that several blocks are probed
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 60)))) for k in range(40)]
    items += [(90, items[7][1].upper()), (91, "solo"), (92, "two words"), (93, None), (94, " \n")]
    texts = []
    for k in range(120):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 200))]
        if k % 2:
            part = rng.choice(items[:40])[1].split()
            for _ in range(rng.randint(0, 3)):  # edits lose up to five shingles each
                part[rng.randrange(len(part))] = "edited"
            words[20:20] = part
        if k % 10 == 0:
            words += ["Two", "WORDS", "solo"]
        texts.append("  ".join(words))
    docs = [*enumerate(texts), (3, texts[9]), (3, texts[9])]
    want = brute(docs, items)
    shares = {found / size for size, found in want.values()}
    assert 1.0 in shares and min(shares) < 0.95 and (0, 92) in want
    assert got(contaminated(documents(docs), spark.createDataFrame(items, SCHEMA))) == want


def test_sketches_grow_with_the_partition(spark):
    item = " ".join(f"w{k}" for k in range(44))  # 40 shingles, in the partition up to 64
    rows = item_shingles(spark.createDataFrame([(1, item), (2, item), (3, "a b c")], SCHEMA))
    assert rows.count() == 41
    assert {(r.length, r["count"]) for r in sketches(rows).groupBy("length").count().collect()} == {(5, 13), (3, 1)}


def test_odd_rows(spark, odd_documents):
    items = spark.createDataFrame([(1, "same text here again"), (2, "word word word word word word"), (None, "one"), (4, "no id")], SCHEMA)
    assert got(contaminated(odd_documents, items)) == {
        (8, 1): (1, 1), (9, 1): (1, 1), (7, 2): (1, 1), (3, None): (1, 1), (None, 4): (1, 1)}
    assert got(contaminated(odd_documents, items.limit(0))) == {} == got(contaminated(odd_documents.limit(0), items))
    extra = odd_documents.selectExpr("*", "1 AS words", "2 AS item", "3 AS hash", "4 AS text_key")
    rest = without_contamination(extra, items.selectExpr("*", "1 AS size", "2 AS words"))
    assert rest.columns == extra.columns and {r.doc_id for r in rest.collect()} == {0, 1, 2, 4, 5, 6, None}
