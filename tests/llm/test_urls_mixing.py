import pytest
from pyspark.sql import functions as F

from terrasift.llm.catalog import RULES
from terrasift.llm.mixing import mix_table, mixed_documents, source_targets
from terrasift.llm.urls import build_index, judge_urls, probe


def entries(spark, listed=()):
    rows = [(*r, True) for r in RULES] + [(h, "", "block", False) for h in listed]
    return spark.createDataFrame(rows, "host string, path string, verdict string, stated boolean")


def judged(spark, urls, listed=()):
    pages = spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)], "page_id long, url string, rule int")
    return {r.page_id: r for r in judge_urls(pages, entries(spark, listed)).collect()}


def test_rules_and_list(spark):
    got = judged(spark, [
        "http://Example.COM/en/1", "https://www.example.com/en/x?y#z", "http://a.b.net/es/", "http://net/fr", "http://x.org/fr/",
        "http://sub.bad.org/q", "http://notbad.org/", "ftp://example.com", None, "no scheme", "http://user@h.net:80/es/a/b", "x://a://b/c", "http://"],
        listed=["bad.org"])
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(13)] == [
        ("example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("a.b.net", "/es/", "net/es/", "block"), ("net", "/fr", None, "allow"), ("x.org", "/fr/", None, "allow"),
        ("sub.bad.org", "/q", None, "block"), ("notbad.org", "/", None, "allow"), ("example.com", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("user@h.net:80", "/es/a/b", None, "allow"), ("a:", "//b/c", None, "allow"), ("", "", None, "allow")]


def test_collision_is_not_a_hit(spark):
    """A probe with the digest of an entry but another string is refused."""
    index = build_index(entries(spark))
    shards = index.select("shards").first()[0]
    forged = index.withColumn("strings", F.regexp_replace(F.decode("strings", "UTF-8"), "com", "cxm").cast("binary"))
    keys = spark.createDataFrame([("com/",), ("net/es/",)], "entry string")
    assert {r.entry for r in probe(index, keys, shards).collect()} == {"com/", "net/es/"}
    assert {r.entry for r in probe(forged, keys, shards).collect()} == {"net/es/"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, entries(spark)).count() == 0
    page = spark.createDataFrame([(None, "http://a.com/"), (None, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(page, entries(spark).limit(0)).collect()] == ["allow", "allow"]


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def test_targets(spark):
    sizes = {"b": 10, "a": 1000, "Z": 40, "é": 3, "zz": 0, None: 500, "10": 70}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_taken_words(spark, documents):
    docs = documents([(k, "w " * (k % 9), "abc"[k % 3] if k % 10 else None) for k in range(3000)])
    rows = mix_table(docs).collect()
    again = {r.doc_id: r.taken for r in mix_table(docs.repartition(5)).collect()}
    assert {r.doc_id: r.taken for r in rows} == again
    taken, target = {}, {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size > 0
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in target)
    copies = mixed_documents(docs)
    assert copies.columns == [*docs.columns, "copy"]
    assert {r.doc_id: r.n for r in copies.groupBy("doc_id").agg(F.count("*").alias("n")).collect() if r.doc_id % 9} == {
        r.doc_id: r.taken // r.size for r in rows if r.taken}


def test_odd_rows(spark, odd_documents):
    assert mix_table(odd_documents).count() == odd_documents.count()
    extra = odd_documents.selectExpr("*", "1 AS size", "2 AS target", "3 AS copies", "4 AS draw", "5 AS source_size")
    assert mix_table(extra).columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert mixed_documents(extra).columns == [*extra.columns, "copy"]
    assert mix_table(odd_documents.limit(0)).count() == 0 and mixed_documents(odd_documents.limit(0)).count() == 0
    blank = odd_documents.filter("doc_id < 3")
    assert [r.taken for r in mix_table(blank).collect()] == [0, 0, 0]
