import math
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from terrasift.operators import text
from terrasift.operators.joins import spread_join

ROWS = [(1, "Red, red BLUE. a b a"), (2, "blue; Ünder_score 12x"), (3, None), (4, " - "), (5, "red red red red"), (6, "漢字 red 🙂 blue"), (None, "a lone row")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(ROWS, "id long, text string")


def words(value):
    return "".join(c if c.isalnum() else " " for c in (value or "").lower()).split()


def test_tokens_and_counts(texts):
    for row in texts.select("text", text.tokens(F.col("text")).alias("t"), text.term_counts(F.col("text")).alias("c")).collect():
        assert row.t == words(row.text)
        assert {x.term: x.tf for x in row.c} == Counter(words(row.text)) and len(row.c) == len(set(row.t))
    assert [r.t for r in texts.filter("id = 1").select(text.tokens(F.col("text"), min_length=2).alias("t")).collect()] == [["red", "red", "blue"]]


def test_weights_by_hand(texts):
    df = Counter(t for _, value in ROWS for t in set(words(value)))
    got = text.weighted_terms(texts.repartition(3), ["id"], "text", hot_rows=1).collect()
    want = {(k, t): (tf, df[t], tf * math.log((len(ROWS) + 1) / (df[t] + 1))) for k, value in ROWS for t, tf in Counter(words(value)).items()}
    assert {(r.id, r.term) for r in got} == set(want)
    for r in got:
        assert (r.tf, r.df) == want[r.id, r.term][:2] and r.weight == pytest.approx(want[r.id, r.term][2])
    first = {r.id: r.term for r in got if r["rank"] == 1}
    assert first[1] == "a" and first[5] == "red" and first[None] == "lone"  # ties by term
    assert max(r["rank"] for r in text.weighted_terms(texts, ["id"], "text", top=2).collect()) == 2
    assert {r.term for r in text.weighted_terms(texts, ["id"], "text", min_docs=3).collect()} == {"red", "blue"}


def test_empty_table_and_missing_column(spark, texts):
    assert text.weighted_terms(texts.limit(0), ["id"], "text").count() == 0
    with pytest.raises(ValueError, match="nothing"):
        text.weighted_terms(texts, ["id"], "nothing")


def test_vectors_are_sparse_and_survive_saving(spark, texts, tmp_path):
    filled = texts.fillna("", ["text"])
    model = Pipeline(stages=text.text_stages("text", "v", 1 << 12)).fit(filled)
    vectors = {r.id: r.v for r in model.transform(filled).collect()}
    assert vectors[5].size == 1 << 12 and len(vectors[5].indices) == 1 and len(vectors[3].indices) == 0
    slot = int(filled.selectExpr(text.slot_sql(1 << 12, "'red'")).first()[0])
    assert vectors[5][slot] == pytest.approx(4 * math.log(8 / 4))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = {r.id: r.v for r in PipelineModel.load(str(tmp_path / "m")).transform(filled).collect()}
    assert again == vectors


def test_frequent_terms_are_dealt(spark):
    left = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, F.lit("of")).when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), "id")
    right = spark.range(6_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).unionByName(
        spark.createDataFrame([("of", 2)], "k string, v int"))
    for how in ("inner", "left"):
        assert sorted(map(str, spread_join(left, right, ["k"], how, 100).collect())) == sorted(map(str, left.join(right, ["k"], how).collect()))


def test_weights_split_every_text_once(spark, monkeypatch):
    def again(*args, **options):
        raise AssertionError("the texts are split again")
    monkeypatch.setattr(text, "document_frequencies", again)
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None)], "id int, t string")
    found = {(r.id, r.term): (r.tf, r.df) for r in text.weighted_terms(df, ["id"], "t").collect()}
    assert found == {(1, "a"): (2, 1), (1, "b"): (1, 2), (2, "b"): (1, 2), (2, "c"): (1, 1)}
