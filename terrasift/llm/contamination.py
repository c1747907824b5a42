"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles in lower case. Items are
partitioned by size, and each item is sketched by its smallest shingle hashes:
as many as the largest item of its partition may miss, plus one. A document that
contains the asked share of an item then has at least one of the sketched hashes,
so probing every shingle of every document against the sketches finds all
candidates, however long the document. They are verified by counting the item's
shingles, as strings, in the document.

Only DataFrame functions are used. The sketches are probed in blocks of at most
``SKETCH_BLOCK`` hashes, each small enough to broadcast whatever the benchmark.

Defined cases: an item with fewer words is one shingle of all its words, looked
for at every place; null and blank items and texts match nothing; items with
equal words are searched once and each reported; rows with one ``doc_id`` give
one row per item with the largest count; rows with a null ``doc_id`` are one
document of that id; empty tables give an empty result. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged, words

SHINGLE, PERCENT = 5, 80
SKETCH_BLOCK = 500_000


def _window(array: Column, at: Column, length: int) -> list[Column]:
    return [array[at + k] for k in range(length)]


def _hash(array: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *_window(array, at, length))


def _string(array: Column, at: Column, length: int) -> Column:
    return F.concat_ws(" ", *_window(array, at, length))


def _shingles(rows: DataFrame, length: int, made: Column, name: str, keys: list[str]) -> DataFrame:
    """One row for each window of ``length`` words of ``words``; ``made`` is computed at position ``at``."""
    full = rows.filter(F.size("words") >= length)
    at = F.explode(F.sequence(F.lit(0), F.size("words") - length))
    return full.select(*keys, "words", at.alias("at")).select(*keys, made.alias(name))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, words): items with equal words share the digest ``item``."""
    rows = benchmark.select("item_id", words(F.lower("text")).alias("words")).filter(F.size("words") > 0)
    return rows.select("item_id", F.xxhash64(F.array_join("words", " ")).alias("item"), "words")


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """Staged distinct shingles of the items: item (digest of its words), length, shingle, hash, size."""
    items = _items(benchmark).select("item", "words").dropDuplicates(["item"])
    parts = []
    for length in range(1, SHINGLE + 1):
        own = items.filter(F.size("words") >= SHINGLE if length == SHINGLE else F.size("words") == length)
        rows = _shingles(own, length, F.struct(_string(F.col("words"), F.col("at"), length).alias("shingle"),
                                               _hash(F.col("words"), F.col("at"), length).alias("hash")), "s", ["item"])
        parts.append(rows.select("item", F.lit(length).alias("length"), "s.shingle", "s.hash"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.distinct()
    sizes = rows.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    return staged(rows.join(sizes, "item"), "items")


def sketches(shingles: DataFrame) -> DataFrame:
    """(length, hash) of the sketches: the smallest hashes of each item, as many as its size partition asks for."""
    largest = F.pow(F.lit(2), F.ceil(F.log2("size"))).cast("long")  # of the partition
    wanted = F.floor(largest * (100 - PERCENT) / 100).cast("int") + 1
    hashes = shingles.groupBy("item", "length").agg(F.sort_array(F.collect_set("hash")).alias("hashes"), F.max("size").alias("size"))
    return hashes.select("length", F.explode(F.slice("hashes", 1, wanted)).alias("hash")).distinct()


def _document_words(documents: DataFrame) -> DataFrame:
    """(doc_id, digest of the text, words): the digest keeps rows with one id apart."""
    return documents.filter("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_key"), words(F.lower("text")).alias("words"))


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of the pairs that reach ``PERCENT``."""
    shingles = item_shingles(benchmark)
    sketch = staged(sketches(shingles), "sketches")
    rows = _document_words(documents.select("doc_id", "text"))
    candidates = None
    # At most SHINGLE lengths, and one block for every SKETCH_BLOCK hashes of the benchmark.
    for length, count in sorted((r["length"], r["count"]) for r in sketch.groupBy("length").count().collect()):
        blocks = -(-count // SKETCH_BLOCK)
        probes = _shingles(rows, length, _hash(F.col("words"), F.col("at"), length), "hash", ["doc_id", "text_key"])
        for block in range(blocks):
            part = sketch.filter((F.col("length") == length) & (F.pmod("hash", F.lit(blocks)) == block)).select("hash", "length")
            hits = probes.join(F.broadcast(part), "hash").select("doc_id", "text_key", "hash", "length").distinct()
            candidates = hits if candidates is None else candidates.unionByName(hits)
    if candidates is None:
        kinds = [documents.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
        return documents.sparkSession.createDataFrame(
            [], f"doc_id {kinds[0]}, item_id {kinds[1]}, n_shingles long, n_found long, containment double")
    pairs = staged(candidates.join(shingles.select("item", "length", "hash"), ["length", "hash"])
                   .select("doc_id", "text_key", "item", "length").distinct(), "candidates")
    # Exact verification, on the candidate documents alone.
    keys = pairs.select("doc_id", "text_key").distinct()
    chosen = _document_words(documents.select("doc_id", "text")).alias("d").join(
        keys.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_key") == F.col("k.text_key")), "left_semi")
    needed = pairs.join(shingles.select("item", "length", "shingle", "size"), ["item", "length"])
    counts = None
    for (length,) in sorted(tuple(r) for r in sketch.select("length").distinct().collect()):
        own = _shingles(chosen, length, _string(F.col("words"), F.col("at"), length), "shingle", ["doc_id", "text_key"]).distinct()
        found = needed.filter(F.col("length") == length).alias("n").join(
            own.alias("o"), F.col("n.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("n.text_key") == F.col("o.text_key"))
            & (F.col("n.shingle") == F.col("o.shingle")))
        found = found.groupBy("n.doc_id", "n.text_key", "item", "size").agg(F.count(F.lit(1)).alias("n_found"))
        counts = found if counts is None else counts.unionByName(found)
    counts = counts.filter(F.col("n_found") * 100 >= F.col("size") * PERCENT)
    best = counts.groupBy("doc_id", "item").agg(F.max("n_found").alias("n_found"), F.max("size").alias("n_shingles"))
    members = _items(benchmark).select("item_id", "item").distinct()
    return best.join(members, "item").select(
        "doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def without_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is contained; rows with an id that is contaminated go, and a null id never does."""
    found = staged(contaminated(documents, benchmark).select("doc_id").distinct(), "contaminated")
    return documents.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
