"""Mix documents so that each source reaches a target share of the tokens.

Words per source are summed with partial aggregation, the targets are found on
the small table of sources, and each document is then taken ``floor(rate)``
times plus once more if a number drawn from its own hash is below the rest.

Defined cases: a null text has no words; rows without a source form one source,
ordered last; a source without words has rate 0; rows with equal ``doc_id`` and
text draw the same number; an empty table gives an empty result. Names of other
columns do not matter, as only working columns with a leading ``_mix`` are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged, with_rank, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5   # words to take, as a share of all words
CEILING = 2.0  # no source is taken more often than this
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) that depends on the seed and the row alone."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources are ranked in code point order, null last, and take the weights in
    turn. Targets are ``level * weight``, cut at ``ceiling`` times the size; the
    level rises until the cut words have all been given to the other sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_rank(totals, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    most = F.col("source_size") * F.lit(float(ceiling))
    level, seen = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > most
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.count(F.when(full, 1)).alias("full"),
            F.sum(F.when(full, most)).alias("spent"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if row["full"] == seen or not row["all"] or not row["open"]:
            break
        seen, level = row["full"], (share * row["all"] - (row["spent"] or 0.0)) / row["open"]
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(level), most).alias("target"))


def with_copies(documents: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows with ``size``, ``source_size``, ``target`` and the number of ``copies`` the mix takes.

    ``documents`` has ``source``, ``size`` and ``draw``. The plan broadcasts the
    sources where the optimizer's own size limit allows and joins by shuffle,
    splitting hot sources, beyond it.
    """
    rates = targets.select(F.col("source").alias("_mix_source"), "source_size", "target")
    joined = documents.join(rates, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = F.col("draw") < rate - F.floor(rate)
    return joined.withColumn("copies", (F.floor(rate) + extra.cast("long")).cast("long"))


def sized(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, draw) of every document: all that the mix needs of a text."""
    return documents.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                            draw(F.col("doc_id"), F.col("text"), seed).alias("draw"))


def mix_table(documents: DataFrame, **settings) -> DataFrame:
    """One row per document with what the mix takes of it; texts are read once."""
    sizes = staged(sized(documents), "sizes")
    rows = with_copies(sizes, source_targets(sizes, **settings))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The mixed corpus itself: each document as often as it is taken, numbered by ``copy`` from 1."""
    targets = source_targets(staged(documents.select("source", word_count(F.col("text")).alias("size")), "sizes"), **settings)
    own = documents.columns
    inner = documents.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_mix"), F.col("source"),
                             F.lit(0).cast("long").alias("size"), draw(F.col("doc_id"), F.col("text")).alias("draw"))
    rows = with_copies(inner, targets).filter("copies > 0")
    copies = rows.select("_mix", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return copies.select(*[F.col("_mix").getField(c).alias(c) for c in own], F.col("_copy").alias("copy"))
