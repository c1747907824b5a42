"""Text features: tokens, hashed term counts, inverse document frequencies.

Two routes share one tokeniser. :func:`text_stages` gives MLlib stages that end
in a sparse weighted vector, for pipelines with a model. :func:`weighted_terms`
keeps the terms themselves, for tables. Slots of terms come from MD5, as all
hashes of this package do, so that any engine finds the same ones.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, CountVectorizerModel, RegexTokenizer, SQLTransformer
from pyspark.sql import Column, DataFrame, Window, functions as F

from terrasift.functions.numeric import quoted
from terrasift.functions.vectors import bound
from terrasift.operators.joins import spread_join
from terrasift.operators.quality import require_columns
from terrasift.session import stage_table

# Tokeniser and vector defaults.
SEPARATORS = r"[^\p{L}\p{N}]+"
SLOTS = 1 << 18
MIN_TOKEN = 1
# End of fixed values.


def tokens(text: Column, separators: str = SEPARATORS, min_length: int = MIN_TOKEN) -> Column:
    """Lower-cased tokens between separators, in order and with repeats; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), separators), lambda t: F.length(t) >= max(1, min_length))


def term_counts(text: Column, **options) -> Column:
    """Array of (term, tf), found by sorting the tokens of the row: no shuffle."""
    def runs(ordered):
        starts = F.filter(F.transform(ordered, lambda t, i: F.when((i == 0) | (F.get(ordered, i - 1) != t), i)), lambda i: i.isNotNull())
        return bound(starts, lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(ordered, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(ordered)) - i).cast("long").alias("tf"))))
    return bound(F.array_sort(tokens(text, **options)), runs)


def inverse_frequency(documents: int, holding: Column) -> Column:
    """``ln((documents + 1) / (holding + 1))``: 0 for a term that every document holds."""
    return F.log((F.lit(float(documents)) + 1) / (holding + 1))


def document_frequencies(df: DataFrame, text_col: str, min_docs: int = 0, **options) -> tuple[DataFrame, int]:
    """(term, df) over all rows, and the number of rows; each row counts once for a term."""
    require_columns(df, [text_col])
    terms = df.select(F.explode(F.array_distinct(tokens(quoted(text_col), **options))).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.filter(F.col("df") >= min_docs) if min_docs else counts, df.count()


def weighted_terms(df: DataFrame, key_cols, text_col: str, top: int | None = None, min_docs: int = 0, hot_rows=None, **options) -> DataFrame:
    """Keys, ``term``, ``tf``, ``df``, ``weight`` = tf · idf and ``rank`` by falling weight, then term.

    With ``top`` only that many terms of each row are returned. Rows with equal keys are one document.
    Terms that fewer than ``min_docs`` rows hold are left out. Frequent terms are dealt over several tasks.
    """
    key_cols = list(key_cols)
    require_columns(df, [*key_cols, text_col])
    rows = df.select(*[quoted(k) for k in key_cols], F.inline(term_counts(quoted(text_col), **options)))
    rows, documents = stage_table(rows, "term-counts"), df.count()
    # A row holds a term once, so the rows of a term are its document frequency and what the join deals by.
    counts = stage_table(rows.groupBy("term").agg(F.count(F.lit(1)).alias("_rows")), "term-frequencies")
    frequent = counts.select("term", F.col("_rows").alias("df")).filter(F.col("df") >= min_docs)
    joined = spread_join(rows, frequent, ["term"], hot_rows=hot_rows, counts=counts.filter("term IS NOT NULL"))
    weight = (F.col("tf") * inverse_frequency(documents, F.col("df"))).alias("weight")
    weighed = joined.select(*[quoted(k) for k in key_cols], "term", "tf", "df", weight)
    order = Window.partitionBy(*[quoted(k) for k in key_cols]).orderBy(F.desc(F.round("weight", 9)), "term")
    ranked = weighed.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top) if top else ranked


def slot_sql(slots: int, term: str = "t") -> str:
    return f"cast(cast(conv(substring(md5({term}), 1, 8), 16, 10) as bigint) % {slots} as string)"


def text_stages(text_col: str, output: str = "features", slots: int = SLOTS, min_docs: int = 0,
                separators: str = SEPARATORS, min_length: int = MIN_TOKEN) -> list:
    """Stages: tokens, their slots, sparse counts per slot, counts weighted by inverse document frequency.

    The vectors have ``slots`` dimensions and as many entries as the row has distinct slots. Fitting is
    one pass that counts the rows of each slot. Rows with a null text must be dropped or filled before.
    """
    words, slotted, counted = (f"{output}_{part}" for part in ("words", "slots", "counts"))
    counter = CountVectorizerModel.from_vocabulary([str(k) for k in range(slots)], inputCol=slotted, outputCol=counted)
    return [
        RegexTokenizer(inputCol=text_col, outputCol=words, pattern=separators, gaps=True, minTokenLength=min_length, toLowercase=True),
        SQLTransformer(statement=f"SELECT *, transform({words}, t -> {slot_sql(slots)}) AS {slotted} FROM __THIS__"),
        counter,
        IDF(inputCol=counted, outputCol=output, minDocFreq=min_docs)]
