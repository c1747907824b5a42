"""Text features of documents."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from terrasift.functions.vectors import vector_to_array
from terrasift.operators import text
from terrasift.plans.catalog import query, table

WORDS_SQL = r"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: length(t) >= 1) AS words FROM documents),
m AS (SELECT count(*)::DOUBLE AS m FROM documents)"""
SLOTS = 256


@query("text_top_terms", f"""
WITH {WORDS_SQL},
c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
s AS (SELECT doc_id, term, tf, df, tf * ln((m + 1) / (df + 1)) AS raw FROM c JOIN f USING (term), m)
SELECT doc_id, term, tf, df, round(raw, 6) AS weight, row_number() OVER (PARTITION BY doc_id ORDER BY round(raw, 9) DESC, term)::INTEGER AS rank
FROM s QUALIFY rank <= 5""")
def text_top_terms(spark, folder):
    """The five terms of each document that weigh most."""
    found = text.weighted_terms(table(spark, folder, "documents"), ["doc_id"], "text", top=5)
    return found.withColumn("weight", F.round("weight", 6))


@query("text_document_frequencies", f"""
WITH {WORDS_SQL}
SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(words) AS term FROM w) GROUP BY term HAVING count(*) >= 2""")
def text_document_frequencies(spark, folder):
    return text.document_frequencies(table(spark, folder, "documents"), "text", min_docs=2)[0]


@query("text_vectors", f"""
WITH {WORDS_SQL},
c AS (SELECT doc_id, (('0x' || substr(md5(term), 1, 8))::BIGINT % {SLOTS})::INTEGER AS slot, count(*) AS tf
 FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY ALL),
f AS (SELECT slot, count(*) AS df FROM c GROUP BY slot)
SELECT doc_id, slot, round(tf * ln((m + 1) / (df + 1)), 6) AS weight FROM c JOIN f USING (slot), m WHERE tf * ln((m + 1) / (df + 1)) > 1e-9""")
def text_vectors(spark, folder):
    """Entries of the sparse weighted vectors of all documents; few slots, so that terms share some."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored = Pipeline(stages=text.text_stages("text", "features", SLOTS)).fit(docs).transform(docs)
    entries = scored.select("doc_id", F.posexplode(vector_to_array("features")).alias("slot", "weight"))
    return entries.filter("weight > 1e-9").select("doc_id", "slot", F.round("weight", 6).alias("weight"))
