import random

import xxhash

from terrasift.llm import simhash
from terrasift.llm.components import components
from terrasift.llm.simhash import simhash_groups


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: {doc_id: fingerprint}; every pair is compared."""
    label = {d: d for d in prints}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d
    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: root(d) for d in ids}


def check(spark_docs, rows):
    prints = {d: brute_fingerprint(t) for d, t in rows}
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in spark_docs.collect()}
    assert got == {d: (f"{prints[d]:016x}", want[d]) for d in prints}
    return want


def test_whole_table(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = check(simhash_groups(docs), [(r["doc_id"], r["text"]) for r in small_documents])
    assert len(set(found.values())) < len(found)


def test_hot_classes_and_components_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 2)
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 999)}" for _ in range(300)]
    rows = [(k, " ".join(base)) for k in range(40)]
    for k in range(40, 80):  # near copies of many fingerprints, in one component
        rows.append((k, " ".join(base[:k] + ["x"] + base[k + 1:])))
    rows += [(k, " ".join(f"v{rng.randint(0, 999)}" for _ in range(50))) for k in range(80, 100)] + [(100, None), (101, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = check(simhash_groups(docs), rows)
    assert len(set(found.values())) < 60


def fingerprints(spark, values):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    return spark.createDataFrame(signed, "fp long")


def linked(spark, values, **settings):
    signed = {(v - (1 << 64) if v >> 63 else v): v for v in values}
    got = {r.a: r.b for r in components(simhash.links(fingerprints(spark, values), **settings)).collect()}
    classes = {}
    for s, v in signed.items():
        classes.setdefault(got.get(s, s), set()).add(v)
    return {frozenset(c) for c in classes.values()}


def brute_classes(values):
    classes = {}
    for v, root in brute_components({v: v for v in values}).items():
        classes.setdefault(root, set()).add(v)
    return {frozenset(c) for c in classes.values()}


def test_dense_groups_and_tiles(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(250)}
    chain, at = [], rng.getrandbits(64)
    for k in range(60):  # neighbours differ by 3 bits, the ends by far more
        chain.append(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
    values = sorted(near | set(chain) | {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1})
    want = brute_classes(values)
    assert linked(spark, values) == want
    assert linked(spark, values, group_limit=4, tile=16) == want


def test_schemes_lose_no_pair():
    rng = random.Random(1)
    for classes in (1, 10**6, 10**9, 10**12):
        keys = simhash.block_scheme(classes)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(all(not diff >> low & (1 << bits) - 1 for low, bits in blocks) for blocks in keys)


def test_odd_rows(spark, odd_documents):
    rows = odd_documents.collect()
    got = simhash_groups(odd_documents).collect()
    assert len(got) == len(rows)
    assert {r.fingerprint for r in got if r.doc_id in (0, 1, 2)} == {"0" * 16}
    assert {r.component_id for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert {r.component_id for r in got if r.doc_id in (8, 9)} == {8}
    unnamed = [r for r in got if r.doc_id is None]  # one is alone, one is blank and joins the blank texts
    assert sorted(r.component_id for r in unnamed if r.component_id is not None) == [0] and len(unnamed) == 2


def test_empty_and_extra_columns(spark, odd_documents):
    assert simhash_groups(odd_documents.limit(0)).count() == 0
    extra = odd_documents.selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS root")
    assert simhash_groups(extra).columns == ["doc_id", "fingerprint", "component_id"]
