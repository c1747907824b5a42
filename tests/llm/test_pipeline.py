import re
import shutil

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.01"


def shingles(text):
    words = text.lower().encode().split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = {r.doc_id: r.asDict() for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        rows = [r.asDict() for r in docs.collect()]
        if name == "mixing":
            out[name] = rows
        else:
            assert docs.columns == corpus_pipeline.COLUMNS
            out[name] = {r["doc_id"]: r for r in rows}
            assert len(out[name]) == len(rows)
    return out


def test_quality(stages):
    before, after = stages["documents"], stages["quality"]
    assert all(after[d] == before[d] for d in after)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist()}
    good, poor = [d for d in labels if labels[d]], [d for d in labels if not labels[d]]
    assert sum(d in after for d in good) >= 0.95 * len(good) and sum(d in after for d in poor) <= 0.2 * len(poor)


def test_near_duplicates(stages):
    before, after = stages["quality"], stages["near_duplicates"]
    groups = brute_components({d: brute_fingerprint(r["text"]) for d, r in before.items()})
    assert after == {d: before[d] for d in set(groups.values())}


def test_decontamination(stages):
    before, after = stages["near_duplicates"], stages["decontamination"]
    items = [shingles(r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    assert after == {d: r for d, r in before.items()
                     if not any(len(i & shingles(r["text"])) >= 0.8 * len(i) for i in items)}
    assert len(after) < len(before)


def test_secrets(stages):
    before, after = stages["decontamination"], stages["secrets"]
    assert before.keys() == after.keys()
    for d, r in after.items():
        assert not brute_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_secrets(before[d]["text"]) and "[SECRET]" not in r["text"]:
            assert r == before[d]
    assert any("[SECRET]" in r["text"] for r in after.values())


def test_mixing(stages):
    before, rows = stages["secrets"], stages["mixing"]
    copies = {}
    for r in rows:
        copies.setdefault(r["doc_id"], []).append(r.pop("copy"))
        assert r == before[r["doc_id"]]
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2 for c in copies.values())


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == [*corpus_pipeline.COLUMNS, "copy"]
    want = sorted((r["doc_id"], r["text"]) for r in stages["mixing"])
    assert sorted((r.doc_id, r.text) for r in got.select("doc_id", "text").collect()) == want


def test_odd_tables(spark, odd_documents, tmp_path):
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    for docs in (odd_documents, odd_documents.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), odd_documents.schema)
            assert docs.columns == corpus_pipeline.COLUMNS
    extra = odd_documents.selectExpr("*", "1 AS words", "2 AS size", "3 AS _row_n")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, extra, str(tmp_path)).columns[:5] == corpus_pipeline.COLUMNS


def test_one_of_each_group_without_ids(spark, documents):
    from terrasift.llm.simhash import keep_first
    rows = documents([(None, "alpha beta"), (None, "alpha beta"), (4, "gamma"), (4, "gamma"), (None, "gamma"), (9, "gamma"), (2, "delta epsilon zeta eta theta")])
    assert sorted((r.doc_id or 0, r.text) for r in keep_first(rows).collect()) == [(0, "alpha beta"), (2, "delta epsilon zeta eta theta"), (4, "gamma")]


def test_no_stage_hides_import_errors():
    text = open(corpus_pipeline.__file__).read()
    assert not re.search(r"except\s+(ImportError|ModuleNotFoundError|Exception)", text)
