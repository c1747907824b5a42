"""The queries of the operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.chunks import repeated_spans
from terrasift.llm.common import table
from terrasift.llm.contamination import contaminated
from terrasift.llm.jaccard import jaccard_groups
from terrasift.llm.mixing import mix_table
from terrasift.llm.pages import extract_texts
from terrasift.llm.pii import find_personal_data
from terrasift.llm.prefix_trie import prefix_trie
from terrasift.llm.ranking import score_documents
from terrasift.llm.search import rank_documents
from terrasift.llm.secrets import scan_documents
from terrasift.llm.simhash import simhash_groups
from terrasift.llm.target_rules import judge_documents
from terrasift.llm.urls import host_and_path, judge_urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
# Words in a host name that put the host on the blocklist of op1.
BAIT = ["adult", "casino", "pills", "poker", "porn", "spam", "warez"]
BAIT_PATTERN = rf"(^|[.-])({'|'.join(BAIT)})([.-]|$)"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame([(*rule, True) for rule in RULES], "host string, path string, verdict string, stated boolean")
    host, _ = host_and_path(F.col("url"))
    listed = (pages.select(host.alias("host")).filter(F.col("host").rlike(BAIT_PATTERN)).distinct()
              .select("host", F.lit("").alias("path"), F.lit("block").alias("verdict"), F.lit(False).alias("stated")))
    return judge_urls(pages, rules.unionByName(listed)).drop("url")


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_texts(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_quality_ranking": op2_quality_ranking,
    "op3_decontamination": op3_decontamination,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_personal_data": op8_personal_data,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_ranked_search": op13_ranked_search,
}

# Terms of op13: runs of ASCII digits, ASCII letters and all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = {
    "op1_url_filter": rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM named)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '{BAIT_PATTERN}') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op3_decontamination": r"""
WITH items AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
pieces AS (
  SELECT item_id, least(len(w), 5) AS length, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda k: array_to_string(w[k:k + least(len(w), 5) - 1], ' '))) AS shingle
  FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, length, shingle FROM pieces),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id),
docs AS (SELECT doc_id, md5(text) AS text_key, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT DISTINCT length FROM wanted),
parts AS (
  SELECT doc_id, text_key, length, unnest(list_transform(range(1, len(w) - length + 2), lambda k: array_to_string(w[k:k + length - 1], ' '))) AS shingle
  FROM docs, lengths WHERE len(w) >= length),
have AS (SELECT DISTINCT doc_id, text_key, length, shingle FROM parts),
found AS (
  SELECT doc_id, text_key, item_id, count(*) AS n_found FROM have JOIN wanted USING (length, shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, max(n_found) AS n_found, max(n_found) / n_shingles AS containment
FROM found JOIN sizes USING (item_id) WHERE n_found * 100 >= n_shingles * 80 GROUP BY doc_id, item_id, n_shingles""",
    "op9_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sizes GROUP BY source),
ordered AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS spent, coalesce(sum(weight) OVER before, 0) AS given,
         sum(weight) OVER () AS weights, 1.5::DOUBLE * sum(source_size) OVER () AS wanted
  FROM sources WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT arg_min((wanted - spent) / (weights - given), source_size / weight) AS level FROM ordered
           WHERE (wanted - spent) / (weights - given) * weight <= most),
targets AS (SELECT source, source_size, least(weight * level, most) AS target FROM ordered, levels),
rated AS (
  SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, ((floor(rate) + (draw < rate - floor(rate))::INT) * size)::BIGINT AS taken FROM rated""",
    "op11_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS lender,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: list_reduce([xor(c, b), 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT],
                                      lambda x, one: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 6 AS head
  FROM (SELECT DISTINCT conv_id FROM turns)),
joined AS (
  SELECT ids.conv_id, turns.place, turns.role, turns.text FROM ids JOIN turns ON turns.conv_id = ids.lender AND turns.place <= head
  UNION ALL SELECT ids.conv_id, turns.place, turns.role, turns.text FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND turns.place > head),
paths AS (
  SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY place) AS said, list(length(text)::BIGINT ORDER BY place) AS chars
  FROM joined GROUP BY conv_id),
rebuilt AS (SELECT ids.conv_id, coalesce(said, []) AS said, coalesce(chars, []) AS chars FROM ids LEFT JOIN paths USING (conv_id)),
members AS (
  SELECT conv_id, d::BIGINT AS depth, len(said)::BIGINT AS length, md5(array_to_string(said[1:d], ',')) || d AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(said[1:d - 1], ',')) || (d - 1) END AS parent, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, parent, depth, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM members GROUP BY node, parent, depth),
children AS (SELECT parent AS node, count(*)::BIGINT AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
totals AS (
  SELECT above.node, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.chars)::BIGINT AS saved_tokens
  FROM full_nodes below JOIN members above ON above.conv_id = below.conv_id AND above.depth <= below.depth GROUP BY above.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN totals USING (node) LEFT JOIN full_nodes p ON p.node = n.parent""",
    "op12_ngram_jaccard": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda k: array_to_string(w[k:k + 4], ' '))) AS shingle
  FROM docs WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(docs.doc_id, coalesce(b, docs.doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = docs.doc_id""",
    "op13_ranked_search": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT row_no, doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM counted),
held AS (SELECT row_no, term, count(*)::BIGINT AS tf FROM (SELECT row_no, unnest(terms) AS term FROM counted) GROUP BY ALL),
spread AS (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term),
weighed AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM spread, corpus),
items AS (
  SELECT row_number() OVER () AS item_no, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
wanted AS (SELECT item_no, item_id, term, count(*)::BIGINT AS times FROM (SELECT item_no, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT item_no, item_id, row_no, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l)))))::BIGINT AS score
  FROM wanted JOIN weighed USING (term) JOIN held USING (term) JOIN counted USING (row_no), corpus GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
